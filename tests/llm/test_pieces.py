import random

import pyarrow as pa
from assaywright.llm import queries, tokens


class Counted:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_odd_texts_whole():
    encoder = tokens.PieceEncoder(queries.tokenizer_path(), most=50)
    signs = ["a", "Bc", "é", "×", "÷", "ß", "ж", "字", "é", "1", ".", ",!", "?", "'s", "'", "-", " ", "  ", "\n", "\n\n", "\t", "\r\n", " ", " ", "\x00", "<|endoftext|>", "<|endof"]
    draw = random.Random(5)
    texts = ["".join(draw.choices(signs, k=draw.randrange(12))) for _ in range(6000)] + [None, "", "x"]
    for part in (texts[:2000], texts[2000:], texts[3999:4001]):
        found, counts = encoder(pa.array(["left out", *part], pa.string())[1:])
        want = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in part]
        assert counts.tolist() == list(map(len, want)) and found.tolist() == [i for ids in want for i in ids]


def test_new_words_share_texts_and_are_remembered():
    encoder = tokens.piece_encoder.__wrapped__(queries.tokenizer_path())
    encoder.tokenizer = counted = Counted(encoder.tokenizer)
    words = [f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyzabcd'[i // 100]}e" for i in range(1000)]
    encoder(pa.array([" ".join(words), ".\n".join(words)]))
    assert counted.texts < 100  # a text a new piece before
    seen = counted.texts
    encoder(pa.array([" ".join(words[::-1][:-1])]))
    assert counted.texts <= seen + 1  # its first word stands without a space
    assert tokens.piece_encoder(queries.tokenizer_path()) is tokens.piece_encoder(queries.tokenizer_path())


def test_pieces_met_lately_stay_known():
    encoder = tokens.PieceEncoder(queries.tokenizer_path(), most=40)
    encoder.tokenizer = counted = Counted(encoder.tokenizer)
    for i in range(30):
        encoder(pa.array([" ".join(["x", "often", "met", *(f"{'abcdefghij'[i % 10]}{c}{'klm'[i // 10]}" for c in "abcdefghij")])]))
        assert len(encoder.known) + len(encoder.before) < 40 + 2 * 13
    seen = counted.texts
    encoder(pa.array(["x often met"]))
    assert counted.texts == seen
