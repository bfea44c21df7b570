import numpy as np

from appfacet.llm import toxic_segments


def corpus(prose):
    rng, texts, labels = np.random.default_rng(2), [], []
    for i in range(300):
        words = prose(i, 60).split()
        for k in range(6 if i % 5 == 0 else 0):
            words.insert(int(rng.integers(0, len(words))), ["vilex", "grotz", "blarn"][k % 3])
        texts.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 5 == 0)))
    texts += [(1000 + i, texts[5][1]) for i in range(40)]  # copies, labelled alike
    labels += [(1000 + i, 1, 1) for i in range(40)]
    return [*texts, (600, None), (601, ""), (602, "w1x1"), (603, " ")], labels


def scores(spark, documents, texts, labels, parts):
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return {r.doc_id: r.score for r in toxic_segments.score_toxicity(documents(texts, parts=parts), frame).collect()}


def test_scores_do_not_depend_on_how_files_are_split(spark, documents, prose):
    texts, labels = corpus(prose)
    one = scores(spark, documents, texts, labels, 1)
    many = scores(spark, documents, texts[::-1], labels[::-1], 7)
    assert one.keys() == many.keys() and all(abs(one[k] - many[k]) < 1e-9 for k in one)


def test_empty_and_short_texts_score_no_more_than_clean_ones(spark, documents, prose):
    texts, labels = corpus(prose)
    found = scores(spark, documents, texts, labels, 3)
    clean = min(found[i] for i in range(300) if i % 5)
    assert all(found[i] <= clean for i in (600, 601, 602, 603)) and clean < 0.5 < found[0]


def test_no_documents(spark, documents):
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert toxic_segments.score_toxicity(documents([]), labels).collect() == []
    assert toxic_segments.score_toxicity(documents([]), labels.filter("false")).collect() == []
