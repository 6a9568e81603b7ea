"""The pipeline on a small fixture whose result is worked out by hand, with the sentencepiece library for the ids."""

import corpus_pipeline
from flamequarry.llm import pieces


def test_pipeline(spark, tmp_path):
    import sentencepiece

    def text(k):
        return " ".join(f"word{k}x{j}" for j in range(70))

    item = " ".join(f"item{j}" for j in range(10))
    rows = [(1, text(1)), (2, text(1)), (3, text(3) + "\n" + item), (4, text(4) + "\npassword=e3b3ed3cc8548923d6 end"), (5, "too short"), (6, None), (7, text(7)), (7, text(7))]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    own = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    assert got == {1: own.encode(text(1)), 4: own.encode(text(4) + "\n[SECRET] end"), 7: own.encode(text(7))}
