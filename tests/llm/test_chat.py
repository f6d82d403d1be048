import hashlib

from assaywright.llm import chat

TEXTS = [r"\### Assistant: </turn> ok", "\\", "\\\\</turn>", "####", "a\\###\\\\", "", None, "</turn>" * 3, "\\" * 5000 + "###"]


def test_round_trip(spark):
    rows = [(1, i, r, t) for i, (r, t) in enumerate(zip(["user", "assistant", "a: #<b\\", None] * 3, TEXTS))]
    rows += [(None, None, "user", "x"), (2, 1, "assistant", "b"), (2, 1, "assistant", "b"), (2, 0, "user", "a")]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn int, role string, text string, score string")
    got = {r["conv_id"]: r for r in chat.report(df).collect()}
    for conv in (1, 2, None):
        turns = sorted(((t if t is not None else -1, r or "", x or "") for c, t, r, x in rows if c == conv), key=lambda x: x[0])
        said = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        learned = "".join(x for _, r, x in turns if r == "assistant")
        r = got[conv]
        assert r["n_turns"] == len(turns) and r["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert chat.report(df.where("false")).count() == 0
    segments = [r["segment"] for r in chat.formatted(chat.canonical(df.where("conv_id = 1"), "conv_id")).orderBy("turn").collect()]
    assert [t for _, t in chat.parsed("".join(segments))] == [t or "" for t in TEXTS]


def test_layouts(spark):
    def turns(records):
        return sorted((r["key"], r["turn"], r["role"], r["text"]) for r in chat.canonical(records, "id").collect())

    mixed = spark.createDataFrame(
        [(1, "p", "r", None, None, None, None), (2, None, None, "i", None, "o", None), (3, None, None, "i", "n", "o", None), (4, None, None, None, None, None, [("human", "q"), ("gpt", "a")]), (5, "only", None, None, None, None, None)],
        "id int, prompt string, response string, instruction string, input string, output string, conversations array<struct<from:string,value:string>>",
    )
    want = [(1, 0, "user", "p"), (1, 1, "assistant", "r"), (2, 0, "user", "i"), (2, 2, "assistant", "o")]
    want += [(3, 0, "user", "i"), (3, 1, "user", "n"), (3, 2, "assistant", "o"), (4, 0, "user", "q"), (4, 1, "assistant", "a")]
    assert turns(mixed) == want
    assert [r["id"] for r in chat.unmatched(mixed).collect()] == [5]


def test_rows_without_any_value_are_turns(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, None, None, None), (2, None, None, None)], "conv_id long, turn long, role string, text string")
    got = sorted(tuple(r) for r in chat.canonical(df, "conv_id").select("key", "role", "text").collect())
    assert got == [(1, "", ""), (1, "user", "a"), (2, "", "")]
