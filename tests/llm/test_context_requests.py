"""The mixer's requests: written and shuffled once, answered from their files."""

from skyledger.llm import context_mixing as M
from skyledger.llm.shared import in_bucket


def test_key_requests_are_shuffled_once_and_words_are_not_sent_back(spark, monkeypatch):
    written, write = [], M.materialize
    monkeypatch.setattr(M, "materialize", lambda df, name: written.append((name, df.columns)) or write(df, name))
    rows = [(k, f"some words {k % 7} and more {k}") for k in range(60)] + [(60, None), (61, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in M.score_texts(docs, ~in_bucket("doc_id", 5, 1)).collect()}
    assert written == [("word-counts", ["block", "bucket", "counts"])]
    assert len(found) == len(rows)
    assert all(r["score"] < 0 and 0 < r["n_known"] <= r["n_tokens"] for r in found.values())


def test_whole_texts_are_shuffled_compressed(spark):
    rows = [(k, f"some words {k % 7} and more {k}, é \n" * 40) for k in range(5000)] + [(None, "no id"), (None, None), (7, ""), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    numbered = M._numbered(docs, ~in_bucket("doc_id", 5, 1))
    frame = M._packed_texts(numbered).toPandas()
    assert sum(map(len, frame["content"])) * 4 < sum(len((t or "").encode()) for _, t in rows)
    back = []
    for _, block in frame.groupby("block"):
        ids, training, texts = M._unpacked_texts(block.sample(frac=1, random_state=1))
        back += [(None if i != i or i is None else int(i), bool(t), x.decode()) for i, t, x in zip(ids.astype(object).where(ids.notna(), None), training, texts, strict=True)]
    want = [(None if r["no_id"] else r["doc_id"], r["training"], r["text"] or "") for r in numbered.collect()]
    assert back == want and frame["block"].nunique() == 2 and {t for _, t, _ in back} == {True, False}
