"""A text is cut into pieces once for its count and its cut."""

from barkeep.llm.batches import tokenizer_file
from barkeep.llm.token_counts import PrefixCounter


class Counting:
    def __init__(self, pieces):
        self.pieces, self.calls = pieces, 0

    def findall(self, text):
        self.calls += 1
        return self.pieces.findall(text)


def test_counted_cuts_a_text_once():
    known = PrefixCounter(tokenizer_file("byte_bpe_50k.json"))
    special = known.specials[0] if known.specials else ""
    texts = ["", "a", "unbelievable words " * 5, "\u00e9\u4e2d\u6587 x  y\n" * 4, f"one two {special} three four five"]
    for text in texts:
        for limit in (0, 1, 3, 7, 1000):
            n = known.count(text)
            assert known.counted(text, limit) == (n, known.within(text, limit) if n > limit else None)
    known.pieces = Counting(known.pieces)
    n, cut = known.counted(texts[2], 3)
    assert n > 3 and cut < len(texts[2]) and known.pieces.calls == 1


def test_only_needed_prefixes_are_counted():
    known, plain = (PrefixCounter(tokenizer_file("byte_bpe_50k.json")) for _ in range(2))
    pieces = [" information", " xqzjkvw", "antidisestablishmentarianism", " \u4e2d\u6587\u5b57", "1234567890", "!?!?--==", " " * 40]
    for piece in pieces:
        assert known.total(piece) == len(plain.merge(piece.encode()))
    one = PrefixCounter(tokenizer_file("byte_bpe_50k.json"))
    assert one.total(" information") == 1 and len(one.states) == 2
    # Forgetting states between pieces changes nothing.
    small = PrefixCounter(tokenizer_file("byte_bpe_50k.json"), most_states=4)
    assert [small.total(p) for p in pieces] == [known.total(p) for p in pieces]
