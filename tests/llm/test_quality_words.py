import codecs

from assaywright.llm import quality


def test_texts_without_common_words(documents):
    """Texts of the same character classes as good ones, but of no language."""
    limits = quality.Limits()
    good = quality.kept(documents).where("lang is not null and n_chars >= 1000").limit(20).collect()
    found = quality.references(documents, limits)
    verdict = quality.judge(found, limits)
    made = [(r["doc_id"], r["text"], codecs.encode(r["text"], "rot13")) for r in good]
    df = documents.sparkSession.createDataFrame(made, "doc_id long, text string, made string")
    for r in df.select(verdict("text").alias("text"), verdict("made").alias("made")).collect():
        assert r["text"].kept and not r["made"].base_failed and not r["made"].kept
        assert r["made"].char_distance <= limits.char_distance
    assert (quality.word_limits(found, limits) < limits.word_distance).all()


def test_kept_against_plain_rules(spark, documents):
    """The verdict from the references by the definition of the distance, one text at a time."""
    import math

    import numpy as np

    limits = quality.Limits(band_documents=10)
    found = quality.references(documents, limits)
    rows = [(r["doc_id"], r["lang"], r["text"]) for r in documents.collect()]

    def apart(p, q):
        total = 0.0
        for a, b in zip(p, q):
            for x in (a, b):
                total += x * math.log2(2 * x / (a + b)) / 2 if x > 0 else 0.0
        return math.sqrt(min(max(total, 0.0), 1.0))

    def shape(text):
        words = [w for w in text.encode().lower().translate(quality._TO_GAP).split()]
        counts = [words.count(w) for w in found.words]
        classes, *_ = quality.histograms(text, {})
        return classes, [c / len(words) for c in counts] + [1 - sum(counts) / len(words)], len(words)

    def longer(n):
        edge = max(e for e in (limits.least_words, *limits.bands) if e <= n)
        return math.sqrt(min(2, n / edge))

    usual: dict = {}
    shapes = {}
    for doc_id, lang, text in rows:
        if len(text.split()) < 20:
            continue
        shapes[doc_id] = shape(text)
        classes, shares, n = shapes[doc_id]
        if lang is not None and n >= limits.least_words and len(text) >= limits.least_chars:
            i, band = found.languages.index(lang), sum(n >= e for e in limits.bands)
            for kind, own, ref, by in ((0, classes, found.classes, 1), (1, shares, found.shares, longer(n))):
                usual.setdefault((kind, i, band), []).append(min(999, int(apart(own, ref[i]) * by * 1000)))
    for kind, table in ((0, found.usual_chars), (1, found.usual_words)):
        for i in range(len(found.languages)):
            for band in range(len(limits.bands) + 1):
                values = sorted(usual.get((kind, i, band), []))
                if len(values) < 10:
                    values = sorted(v for j in range(len(found.languages)) for v in usual.get((kind, j, band), []))
                if len(values) < 10:
                    assert np.isnan(table[i, band])
                    continue
                at = [values[math.ceil(q * len(values)) - 1] for q in (0.1, 0.5)]
                assert abs(table[i, band] - (at[1] + limits.spread * (at[1] - at[0]) + 1) / 1000) < 0.012
    chars = quality.char_limits(found, limits)
    verdicts = {r["doc_id"]: r["v"] for r in documents.select("doc_id", quality.judge(found, limits)("text").alias("v")).collect()}
    judged = 0
    for doc_id, _, text in rows:
        v = verdicts[doc_id]
        want = not v.base_failed
        if want and v.n_words >= limits.least_words and len(text) >= limits.least_chars:
            judged += 1
            classes, shares, n = shapes[doc_id]
            band = sum(n >= e for e in limits.bands)
            most, told = quality.word_limits(found, limits, longer(n)), quality.words_judged(found, limits, longer(n))
            beyond = [max(apart(classes, found.classes[i]) / chars[i, band], apart(shares, found.shares[i]) / most[i, band] if told[i, band] else 0)
                      for i in range(len(found.languages))]
            if abs(min(beyond) - 1) < 1e-6:
                continue
            want = min(beyond) <= 1
        assert v.kept == want
    assert judged > 50
