from collections import Counter

from assaywright.llm import simhash


def test_one_document_of_each_group(docs_of):
    text = [" ".join(f"{w}{k * 37 + i}" for i in range(40)) for k, w in enumerate(("ape", "bee", "cat", "dog", "elk"))]
    df = docs_of(
        (None, text[0]), (None, text[1]), (None, text[1], "de", "t"), (5, text[2]), (5, text[3]), (3, text[3]), (7, text[4]), (7, text[4]), (None, text[4]),
        (8, None), (None, None), (None, None), (None, None, None, None),
    )
    left = simhash.without_near_duplicates(df)
    assert left.columns == df.columns
    assert Counter((r["doc_id"], r["text"]) for r in left.collect()) == Counter([(None, text[0]), (None, text[1]), (5, text[2]), (3, text[3]), (7, text[4]), (8, None)])
    unnamed = df.where("doc_id is null")
    assert Counter(r["text"] for r in simhash.without_near_duplicates(unnamed).collect()) == Counter([text[0], text[1], text[4], None])
