"""SentencePiece encoding and decoding for merge-type vocabularies.

A text's characters start as symbols, and an agenda of adjacent pairs that form a piece
is worked off by score, the leftmost first among equals; a merged symbol puts its new
neighbours on the agenda. Symbols left outside the vocabulary are written as bytes.
Two neighbouring characters that stand together in no piece never meet in a symbol. So the
stretches between such places (a word, a comma, a line break) never influence one another:
they are encoded on their own and remembered per worker. In each Arrow batch, every stretch met for the first time is
checked against the library, whose ids win should they ever differ (``corrected`` counts).

Null texts count as empty (no ids, empty decoded text).
"""

import hashlib
import heapq

import numpy as np
import pyarrow as pa
import sentencepiece

from barkeep.llm.batches import pick, slices, to_batch, tokenizer_file

BLANK = "▁"
# Stretches up to so many characters are merged side by side; longer ones with a heap each.
LISTED = 64
ROWS = 4096
NONE = np.int32(2**31 - 1)

_DIGEST = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_sha256", pa.string()),
        ("decoded_sha256", pa.string()),
    ]
)
DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class PieceCodec:
    """Encodes and decodes with one vocabulary; build one per worker with ``codec``."""

    def __init__(self, path, most=200_000):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        lib, n = self.library, self.library.get_piece_size()
        self.score, self.id, self.byte_id, self.text = {}, {}, {}, {}
        for i in range(n):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                self.byte_id[int(piece[3:-1], 16)] = i
            elif not (lib.is_control(i) or lib.is_unknown(i)):
                shown = piece.replace(BLANK, " ")
                self.score[shown], self.id[shown] = lib.get_score(i), i
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.text = {i: piece for piece, i in self.id.items()}
        places = {s: n for n, s in enumerate(sorted(set(self.score.values()), reverse=True))}
        self.order = {piece: places[s] for piece, s in self.score.items()}
        self._tables()
        self.known, self.most, self.corrected = {"": ""}, most, 0

    def _tables(self):
        """Number the symbols; pairs that form a piece, sorted, with the piece's place in score order."""
        symbols = {c: n for n, c in enumerate(sorted({c for p in self.id for c in p} | set(self.id)), 1)}
        self.symbol = symbols
        self.written = [""] * (len(symbols) + 1)
        for shown, n in symbols.items():
            self.written[n] = ",".join(map(str, self.numbers([shown])))
        pairs = {}
        for piece in self.id:
            for cut in range(1, len(piece)):
                left, right = symbols.get(piece[:cut]), symbols.get(piece[cut:])
                if left and right:
                    pairs[left << 32 | right] = piece
        self.pairs = np.array(sorted(pairs), np.int64)
        self.places = np.array([self.order[pairs[p]] for p in sorted(pairs)], np.int32)
        self.merged = np.array([symbols[pairs[p]] for p in sorted(pairs)], np.int64)
        # Neighbouring characters that stand together in no piece never meet in a symbol.
        # The table may hold more pairs than it should, which only leaves a cut out.
        self.together = np.zeros(1 << 22, bool)
        pairs = {p[i : i + 2] for p in self.id for i in range(len(p) - 1)}
        self.together[self._slot(*(np.array([ord(p[i]) for p in pairs], np.uint32) for i in (0, 1)))] = True

    @staticmethod
    def _slot(left, right):
        return (left * np.uint32(2654435761) + right * np.uint32(40503)) >> np.uint32(10)

    def stretches(self, texts):
        """Per text, the stretches that merge on their own."""
        whole = "\n".join([" " + text for text in texts]).replace(BLANK, " ")
        chars = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        apart = ~self.together[self._slot(chars[:-1], chars[1:])]
        sizes = np.array([len(text) + 2 for text in texts])
        starts = np.concatenate([[0], np.cumsum(sizes)])
        apart[starts[1:-1] - 1] = apart[starts[1:-1] - 2] = True
        cuts = np.concatenate([[0], np.flatnonzero(apart) + 1, [len(whole)]])
        first = np.searchsorted(cuts, starts[:-1])
        last = np.searchsorted(cuts, starts[1:] - 1)
        cuts = cuts.tolist()
        return [
            [whole[a:b] for a, b in zip(cuts[i:j], cuts[i + 1 : j + 1])] if text else []
            for i, j, text in zip(first.tolist(), last.tolist(), texts)
        ]

    def learn(self, parts):
        """Encode stretches not met before, and check them against the library."""
        known = self.known
        parts = sorted(parts, key=len)
        for start in range(0, len(parts), ROWS):
            self.agendas(parts[start : start + ROWS])
        # A line break stands apart from what follows, so what the library adds in front is cut off.
        for part, ids in zip(parts, self.library.encode(["\n" + part for part in parts], num_threads=1)):
            right = ",".join(map(str, ids[2:]))
            if right != known[part]:
                known[part] = right
                self.corrected += 1

    def agendas(self, parts):
        """Work off the agendas of many short stretches side by side, a merge of each at a time."""
        short = [part for part in parts if len(part) <= LISTED]
        for part in parts[len(short) :]:
            self.known[part] = ",".join(map(str, self.heaped(part)))
        if not short:
            return
        sizes = np.array([len(part) for part in short])
        chars, which = np.unique(
            np.frombuffer("".join(short).encode("utf-32-le"), np.uint32), return_inverse=True
        )
        extra, numbers = {}, []
        for c in map(chr, chars.tolist()):
            if c not in self.symbol:
                extra[len(self.written) + len(extra)] = ",".join(str(self.byte_id[b]) for b in c.encode())
                numbers.append(len(self.written) + len(extra) - 1)
            else:
                numbers.append(self.symbol[c])
        width = int(sizes.max())
        place = np.arange(width)
        symbols = np.zeros((len(short), width + 1), np.int64)
        symbols[:, :width][place < sizes[:, None]] = np.array(numbers, np.int64)[which]
        ranks = self._ranks(symbols[:, :-1], symbols[:, 1:])
        rows = np.arange(len(short))
        final = symbols.copy()
        while len(rows):
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), at]
            done = best == NONE
            if done.any():
                final[rows[done], : symbols.shape[1]] = symbols[done]
                keep = ~done
                rows, symbols, ranks, at, best = rows[keep], symbols[keep], ranks[keep], at[keep], best[keep]
                if not len(rows):
                    break
            own = np.arange(len(rows))
            whole = self.merged[np.searchsorted(self.pairs, symbols[own, at] << 32 | symbols[own, at + 1])]
            moves = np.arange(symbols.shape[1] - 1) > at[:, None]
            symbols[:, :-1] = np.where(moves, symbols[:, 1:], symbols[:, :-1])
            symbols[:, -1] = 0
            ranks[:, :-1] = np.where(moves[:, :-1], ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = NONE
            symbols[own, at] = whole
            ranks[own, at] = self._ranks(symbols[own, at], symbols[own, at + 1])
            has = at > 0
            ranks[own[has], at[has] - 1] = self._ranks(symbols[own[has], at[has] - 1], symbols[own[has], at[has]])
        written, known = self.written, self.known
        for part, row in zip(short, final.tolist()):
            row = row[: row.index(0)]
            known[part] = ",".join([written[n] if n < len(written) else extra[n] for n in row])

    def _ranks(self, left, right):
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where(self.pairs[at] == keys, self.places[at], NONE)

    def heaped(self, part):
        """Ids of a long stretch: its agenda is a heap."""
        n, order = len(part), self.order
        symbol = list(part)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            rank = order.get(part[i : i + 2])
            if rank is not None:
                heap.append((rank, i, 2))
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = after[i]
            if symbol[i] is None or j >= n or len(symbol[i]) + len(symbol[j]) != size:
                continue
            whole = symbol[i] = symbol[i] + symbol[j]
            symbol[j] = None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                rank = order.get(whole + symbol[k])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, size + len(symbol[k])))
            h = before[i]
            if h >= 0:
                rank = order.get(symbol[h] + whole)
                if rank is not None:
                    heapq.heappush(heap, (rank, h, size + len(symbol[h])))
        return self.numbers(s for s in symbol if s is not None)

    def numbers(self, symbols):
        ids = []
        for s in symbols:
            if s in self.id:
                ids.append(self.id[s])
            else:
                ids.extend(self.byte_id[b] for b in s.encode())
        return ids

    def encode(self, texts):
        """Ids of each text, as one string of decimal numbers joined by commas."""
        parts = self.stretches(texts)
        needed = set().union(*parts)
        if len(self.known) + len(needed) > self.most:
            self.known.clear()
            self.known[""] = ""
        self.learn(needed - self.known.keys())
        known = self.known.__getitem__
        return [",".join(map(known, part)) for part in parts]

    def forget(self):
        """Give back what was remembered: workers outlive their tasks, and other operators need the room."""
        self.known = {"": ""}

    def decode(self, ids):
        """Text of a list of ids; bytes that are no UTF-8 become replacement characters."""
        raw = b"".join(
            bytes((self.byte_of[i],)) if i in self.byte_of else self.text.get(i, "").encode() for i in ids
        )
        text = raw.decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text

    def texts(self, coded):
        """Decoded texts of encoded strings, by a table from number to bytes."""
        table = self._bytes
        for ids in coded:
            text = b"".join(map(table.__getitem__, ids.split(","))).decode("utf-8", "replace") if ids else ""
            yield text[1:] if text.startswith(" ") else text

    @property
    def _bytes(self):
        if not hasattr(self, "_by_number"):
            self._by_number = {str(i): bytes((b,)) for i, b in self.byte_of.items()}
            self._by_number.update((str(i), piece.encode()) for i, piece in self.text.items())
        return self._by_number


_codecs = {}


def codec(path):
    if path not in _codecs:
        _codecs[path] = PieceCodec(path)
    return _codecs[path]


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def piece_digests(docs, vocabulary="piece_bpe_32k.model", id_col="doc_id", text_col="text"):
    """One row per row of ``docs``: number of ids and digests of the ids and of the decoded text.

    Null ids stay null, null and empty texts have no ids, repeated rows each get their row,
    further columns are not read. A text of any length is encoded whole.
    """

    def run(batches):
        known = codec(tokenizer_file(vocabulary))
        for batch in batches:
            for rows, raws in slices(batch, "text"):
                texts = [raw.decode("utf-8", "replace") for raw in raws]
                coded = known.encode(texts)
                decoded = known.texts(coded)
                yield to_batch(
                    _DIGEST,
                    rows.column("doc_id"),
                    [ids.count(",") + 1 if ids else 0 for ids in coded],
                    [_sha(ids) for ids in coded],
                    [_sha(text) for text in decoded],
                )
        known.forget()

    return pick(docs, id_col, text_col).mapInArrow(run, DIGEST)


def encoded_pieces(docs, vocabulary="piece_bpe_32k.model", id_col="doc_id", text_col="text"):
    """One row per row of ``docs``: ``doc_id``, the ``ids`` and the ``decoded`` text."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())]
    )

    def run(batches):
        known = codec(tokenizer_file(vocabulary))
        for batch in batches:
            for rows, raws in slices(batch, "text"):
                texts = [raw.decode("utf-8", "replace") for raw in raws]
                coded = known.encode(texts)
                ids = [np.fromstring(c, np.int32, sep=",") for c in coded]
                yield to_batch(schema, rows.column("doc_id"), ids, list(known.texts(coded)))
        known.forget()

    return pick(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, decoded string")
