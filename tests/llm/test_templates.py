import hashlib
import re
from collections import defaultdict

from assaywright.llm import templates

TREE = templates.Tree(least_documents=3)


def brute(pairs, tree):
    lines, leaves = [], defaultdict(set)
    for d, t in pairs:
        for i, line in enumerate((t or "").split("\n")):
            tokens = tuple("<*>" if re.search("[0-9]", w) else w for w in re.findall(r"[^\x20\x09-\x0D]+", line))
            if len(tokens) >= tree.least_tokens:
                leaf = (len(tokens), tokens[: tree.depth])
                lines.append(((d, t), i, leaf, tokens))
                leaves[leaf].add((d, t))
    spots, known, out = defaultdict(set), defaultdict(set), defaultdict(set)
    for doc, _, leaf, tokens in lines:
        for at, w in enumerate(tokens):
            spots[leaf, at, w].add(doc)
    shaped = []
    for doc, i, leaf, tokens in lines:
        shape = tuple(w if w != "<*>" and len(spots[leaf, at, w]) >= tree.least_documents else "<*>" for at, w in enumerate(tokens))
        if sum(w != "<*>" for w in shape) / len(shape) >= tree.least_constant:
            shaped.append((doc, i, (leaf, shape)))
            known[leaf, shape].add(doc)
    for doc, i, shape in shaped:
        if len(known[shape]) >= tree.least_documents:
            out[doc].add(i)
    left = lambda t, gone: "\n".join(x for i, x in enumerate((t or "").split("\n")) if i not in gone)
    return [(d, len(out[d, t]), hashlib.sha256(left(t, out[d, t]).encode()).hexdigest()) for d, t in pairs]


def test_templates(docs_of, documents):
    logs = [(i, f"own line number {i} of this document\nUser u{i} logged in from 10.0.0.{i} today\nshort\n\nend {i}") for i in range(6)]
    odd = docs_of(*logs, logs[0], (None, logs[1][1]), (7, None), (8, ""), (9, "User u1 logged in from 1 tomorrow"), (10, "word " * 3000))
    for df, tree in ((odd, TREE), (documents, TREE), (documents, templates.Tree())):
        want = brute([(r["doc_id"], r["text"]) for r in df.collect()], tree)
        got = [tuple(r) for r in templates.report(df, tree).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    found = {r["doc_id"]: r["n_dropped_lines"] for r in templates.report(odd, TREE).collect()}
    assert found[3] == 2 and found[9] == 0
    left = templates.without_recurring_lines(odd, tree=TREE)
    assert left.columns == [*odd.columns, "__gone"] and left.where("doc_id = 7").first()["text"] is None
    assert templates.report(odd.where("false")).count() == 0


def test_templates_at_two_sizes(spark):
    """One format with two fields of 30 values without digits, one line a document, loses all its lines at any size."""
    word = lambda k: "".join("abcdefghij"[int(c)] for c in f"{k:04d}")
    for size in (300, 9000):
        said = lambda i: f"session of user {word(i % 30)} was opened from host {word(i // 30 % 30)} again"  # noqa: B023, E731
        other = lambda i: f"session of user accounts {word(i)} may be kept as {word(7 * i)} said"
        df = spark.createDataFrame([(i, f"{said(i)}\nOwn {word(i)} line") for i in range(size)] + [(size + i, other(i)) for i in range(20)], "doc_id long, text string")
        gone = {r["doc_id"]: r["n_dropped_lines"] for r in templates.report(df).collect()}
        assert all(gone[i] >= 1 for i in range(size))


def test_what_recurs_in_two_documents(docs_of):
    df = docs_of(
        (1, "Read more\nmine alone\nPosted by anna in the news of today\n2020 11 12 13 14"), (2, " Read  more \nPosted by ben in the news of today\n2020 11 12 13 14"),
        (3, "Once only\nOnce only\n12"), (4, "\n \n13"), (5, "\n \n"), (6, "Posted in the news by anna of today"), (7, "Posted in the news by ben of today"),
    )
    found = {r["doc_id"]: r["n_dropped_lines"] for r in templates.report(df).collect()}
    assert found == {1: 2, 2: 2, 3: 0, 4: 0, 5: 0, 6: 1, 7: 1}
    left = {r["doc_id"]: r["text"] for r in templates.without_recurring_lines(df.where("doc_id < 3")).collect()}
    assert left == {1: "mine alone\nPosted by anna in the news of today", 2: "Posted by ben in the news of today"}
