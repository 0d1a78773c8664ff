"""Token counts of byte-level BPE at every prefix of a text.

A token sequence is the encoding of a piece exactly if every two neighbours of it
encode to themselves. So the encoding of a prefix is the encoding of a shorter prefix
plus one token that gets on with the last token before it, and one left-to-right pass
over a piece gives the exact count at each of its prefixes. Pieces are the vocabulary's
own pre-tokens, which merge independently; their tables are remembered per worker.

Null texts count as empty. A count at a prefix is the count of encoding just that prefix.

``token_counts`` answers one limit as it goes. ``stored_counts`` keeps the counts instead: a row per text with the ends of
its pieces, the count at each, and the counts inside pieces of more than one token. ``answered`` reads
truncation and budget questions off them, for any number of limits, without the texts.
"""

import json
from bisect import bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex

from barkeep.llm.batches import Memo, pick, slices, to_batch, tokenizer_file

# Fixed value: the published pre-token pattern of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Longer pieces get a table of their own; shorter ones share the states of equal prefixes.
SHARED_BYTES = 64

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, bytes_within_limit long"
_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("n_tokens", pa.int64()),
        ("over_limit", pa.bool_()),
        ("bytes_within_limit", pa.int64()),
    ]
)


def _byte_of_char():
    """The printable stand-ins that byte-level vocabularies write bytes with."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in set(plain)):
        table[chr(256 + n)] = b
    return table


class PrefixCounter:
    """Exact token counts at all prefixes; build one per worker with ``counter``."""

    def __init__(self, path, most_states=700_000):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        stand_in = _byte_of_char()
        raw = lambda token: bytes(stand_in[c] for c in token)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.tokens = {raw(t) for t in spec["model"]["vocab"] if t not in set(self.specials)}
        self.rank = {}
        for n, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.rank.setdefault((raw(left), raw(right)), n)
        self.longest = max(map(len, self.tokens))
        self.pieces = regex.compile(PATTERN)
        self.split = regex.compile("|".join(map(regex.escape, self.specials))) if self.specials else None
        self.reach = {}
        for token in self.tokens:
            end = token[-2:]
            self.reach[end] = max(len(token), self.reach.get(end, 0))
        self.edges = Memo(self._edges, most_states)
        self.fits = Memo(lambda pair: self._fits(*pair), most_states // 2)
        self.states, self.most_states = {b"": 0}, most_states
        self.size = Memo(self.total, most_states)

    def merge(self, raw):
        """Reference encoding of a few bytes, merge by merge."""
        parts = [raw[i : i + 1] for i in range(len(raw))]
        rank = self.rank
        while len(parts) > 1:
            best = min(rank.get(p, 1 << 40) for p in zip(parts, parts[1:]))
            if best == 1 << 40:
                break
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and rank.get((parts[i], parts[i + 1])) == best:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def _edges(self, token):
        """Pieces at the token's left and right edge while it grows, as (piece, born, dies) in merge ranks."""
        parts, born, made = [token[i : i + 1] for i in range(len(token))], {}, {}
        while len(parts) > 1:
            best, i = min((self.rank.get(p, 1 << 40), i) for i, p in enumerate(zip(parts, parts[1:])))
            if best == 1 << 40:
                return None
            whole = parts[i] + parts[i + 1]
            born[whole], made[whole] = best, (parts[i], parts[i + 1])
            parts[i : i + 2] = [whole]
        edges = []
        for side in (0, 1):
            piece, dies, edge = token, 1 << 40, []
            while piece:
                edge.append((piece, born.get(piece, -1), dies))
                dies = born.get(piece, -1)
                piece = made[piece][side] if piece in made else b""
            edges.append(edge)
        return edges

    def _fits(self, left, right):
        """Whether the two tokens (the left one may be missing) stay apart when encoded together."""
        if self.edges[right] is None or (left and self.edges[left] is None):
            return False
        if not left:
            return True
        for x, x_born, x_dies in self.edges[left][1]:
            for y, y_born, y_dies in self.edges[right][0]:
                if x_born <= y_dies and y_born <= x_dies:
                    rank = self.rank.get((x, y))
                    if rank is not None and rank < x_dies and rank <= y_dies:
                        return False
        return True

    def state(self, raw):
        """256 * tokens + length of the last token of the encoding of ``raw``.

        The same is stored for each prefix that was needed for it, as plain numbers that the garbage collector skips.
        """
        known = self.states
        if raw in known:
            return known[raw]
        if len(known) >= self.most_states:
            known.clear()
            known[b""] = 0
        return self._state(raw)

    def _state(self, raw):
        known, tokens, fits, n = self.states, self.tokens, self.fits, len(raw)
        for start in range(max(0, n - self.reach.get(raw[max(0, n - 2) :], 1)), n):
            token = raw[start:]
            if token in tokens:
                # Only what stands before such a token is asked for: most pieces are few tokens.
                head = raw[:start]
                before = known.get(head)
                if before is None:
                    before = self._state(head)
                if fits[raw[start - (before & 255) : start], token]:
                    known[raw] = found = (before | 255) + 1 + n - start
                    return found
        raise ValueError(f"the vocabulary cannot write {raw!r}")

    def table(self, raw):
        """Token count of each prefix of one piece: entry i is for its first i bytes."""
        n = len(raw)
        if n <= SHARED_BYTES:
            return [self.state(raw[:i]) >> 8 for i in range(n + 1)]
        counts, last = [0] * (n + 1), [b""] * (n + 1)
        for end in range(1, n + 1):
            for start in range(max(0, end - self.longest), end):
                token = raw[start:end]
                if token in self.tokens and self.fits[last[start], token]:
                    counts[end], last[end] = counts[start] + 1, token
                    break
            else:
                raise ValueError(f"the vocabulary cannot write {raw[:end]!r}")
        return counts

    def total(self, piece):
        raw = piece.encode()
        return self.state(raw) >> 8 if len(raw) <= SHARED_BYTES else self.table(raw)[-1]

    def segments(self, text):
        """(text between special tokens, whether a special token follows it)."""
        if self.split is None:
            return [(text, False)]
        found, at = [], 0
        for m in self.split.finditer(text):
            found.append((text[at : m.start()], True))
            at = m.end()
        return [*found, (text[at:], False)]

    def count(self, text):
        if self.specials and any(s in text for s in self.specials):
            size = self.size
            return sum(
                sum(map(size.__getitem__, self.pieces.findall(part))) + special
                for part, special in self.segments(text)
            )
        return sum(map(self.size.__getitem__, self.pieces.findall(text)))

    def prefix_counts(self, text):
        """Count of ``text[:i]`` for each character position i, for texts without special tokens."""
        counts, before, run = [0], 0, ""
        for piece in self.pieces.findall(text):
            whole = self.table(piece.encode())
            size = 0
            for i, char in enumerate(piece, 1):
                size += len(char.encode())
                part = run + piece[:i]
                found = self.pieces.findall(part)
                # Only a cut inside blanks or a contraction divides otherwise than the whole.
                if found == [part] and not run:
                    counts.append(before + whole[size])
                else:
                    held = self.size[run] if run else 0
                    counts.append(before - held + sum(self.size[p] for p in found))
            before += whole[-1]
            run = piece if piece.isspace() else ""
        return counts

    def counted(self, text, limit):
        """``count`` and, if that is over the limit, ``within`` (else None) of a text, cut into pieces once."""
        if self.specials and any(s in text for s in self.specials):
            n = self.count(text)
            return n, self.within(text, limit) if n > limit else None
        found = self.pieces.findall(text)
        sizes = list(map(self.size.__getitem__, found))
        n = sum(sizes)
        return n, self._cut(found, sizes, limit)[0] if n > limit else None

    def _cut(self, found, sizes, budget):
        """Bytes of the pieces ``found`` that take ``budget`` tokens at most, whether all do, and what is left of it."""
        sums = list(accumulate(sizes))
        k = bisect_right(sums, budget)
        done = len("".join(found[:k]).encode())
        budget -= sums[k - 1] if k else 0
        if k == len(found):
            return done, True, budget
        raw = found[k].encode()
        counts = self.table(raw)
        fit = max(
            i
            for i in range(len(raw) + 1)
            if counts[i] <= budget and (i == len(raw) or raw[i] & 0xC0 != 0x80)
        )
        return done + fit, False, budget

    def within(self, text, limit):
        """Bytes of the longest prefix of whole characters that takes ``limit`` tokens at most,
        and that is also the start of the whole text's encoding up to its last piece."""
        budget, done = limit, 0
        for part, special in self.segments(text):
            found = self.pieces.findall(part)
            size, whole, budget = self._cut(found, map(self.size.__getitem__, found), budget)
            done += size
            if not whole:
                return done
            if special:
                if not budget:
                    return done
                budget -= 1
                done += len(self.split.match(text.encode()[done:].decode()).group().encode())
        return done


_counters = {}


def counter(path):
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def token_counts(docs, vocabulary="byte_bpe_50k.json", limit=512, id_col="doc_id", text_col="text"):
    """One row per row of ``docs``: bytes, tokens, whether over ``limit``, and where to cut.

    Null ids stay null, null texts count as empty, repeated rows each get their row,
    further columns are not read. ``bytes_within_limit`` is the length of the longest
    prefix of whole characters that the stored counts put within the limit.
    """

    def run(batches):
        known = counter(tokenizer_file(vocabulary))
        for batch in batches:
            for rows, raws in slices(batch, "text"):
                texts = [raw.decode("utf-8", "replace") for raw in raws]
                counted = [known.counted(text, limit) for text in texts]
                yield to_batch(
                    _OUT,
                    rows.column("doc_id"),
                    [len(raw) for raw in raws],
                    [n for n, _ in counted],
                    [n > limit for n, _ in counted],
                    [len(raw) if cut is None else cut for raw, (_, cut) in zip(raws, counted)],
                )

    return pick(docs, id_col, text_col).mapInArrow(run, SCHEMA)


STORED = "doc_id long, n_bytes long, ends array<int>, counts array<int>, inner array<binary>"


def _stored_pieces(known, text):
    """(end, count, inner) of each piece: bytes and tokens up to its end; where its own tokens are spent, as bytes.

    Entry k of ``inner`` is the longest prefix of the piece, of whole characters, that takes k + 1 tokens at most.
    A special token is a piece that takes one token.
    """
    end = count = 0
    for part, special in known.segments(text):
        for piece in known.pieces.findall(part):
            raw = piece.encode()
            table = known.table(raw)
            spent = [0] * max(0, table[-1] - 1)
            for i, n in enumerate(table[:-1]):
                if n and raw[i] & 0xC0 != 0x80:
                    for k in range(n - 1, len(spent)):
                        spent[k] = i
            end, count = end + len(raw), count + table[-1]
            yield end, count, np.array(spent, "<u4").tobytes() if spent else None
        if special:
            end += len(known.split.match(text.encode()[end:].decode()).group().encode())
            count += 1
            yield end, count, None


def stored_counts(docs, vocabulary="byte_bpe_50k.json", id_col="doc_id", text_col="text"):
    """One row per row of ``docs`` with its counts, to be written once and asked by ``answered``."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_bytes", pa.int64()),
            ("ends", pa.list_(pa.int32())),
            ("counts", pa.list_(pa.int32())),
            ("inner", pa.list_(pa.binary())),
        ]
    )

    def run(batches):
        known = counter(tokenizer_file(vocabulary))
        for batch in batches:
            for rows, raws in slices(batch, "text", 500_000):
                found = [list(_stored_pieces(known, raw.decode("utf-8", "replace"))) for raw in raws]
                columns = [[[piece[k] for piece in pieces] for pieces in found] for k in range(3)]
                yield to_batch(schema, rows.column("doc_id"), [len(raw) for raw in raws], *columns)

    return pick(docs, id_col, text_col).mapInArrow(run, STORED)


def answered(stored, limits):
    """A row per row of ``stored`` and limit: ``doc_id``, ``n_tokens``, ``token_limit``, ``over_limit``, ``bytes_within_limit``."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_tokens", pa.int64()),
            ("token_limit", pa.int64()),
            ("over_limit", pa.bool_()),
            ("bytes_within_limit", pa.int64()),
        ]
    )

    def within(ends, counts, inner, limit):
        k = bisect_right(counts, limit)
        if k == len(counts):
            return ends[-1] if ends else 0
        done, used = (ends[k - 1], counts[k - 1]) if k else (0, 0)
        room = limit - used
        if room < 1 or inner[k] is None:
            return done
        return done + int(np.frombuffer(inner[k], "<u4")[room - 1])

    def run(batches):
        for batch in batches:
            out = [[] for _ in schema]
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "ends", "counts", "inner"))
            for doc_id, ends, counts, inner in zip(*columns):
                n = counts[-1] if counts else 0
                for limit in limits:
                    row = (doc_id, n, limit, n > limit, within(ends, counts, inner, limit))
                    for column, value in zip(out, row):
                        column.append(value)
            yield to_batch(schema, *out)

    return stored.mapInArrow(
        run, "doc_id long, n_tokens long, token_limit long, over_limit boolean, bytes_within_limit long"
    )
