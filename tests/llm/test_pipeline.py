"""The pipeline's stages against what each should do with its own input."""

import glob

import corpus_pipeline as pipeline
from cases import documents, empty, shingles
from pyspark.sql import functions as F

from incidentry.llm import queries
from incidentry.sources.workspace import discard

SF = "/root/testdata/sf0.001"


def test_language_stage_on_odd_rows(spark):
    """Labelled rows among odd ones: nulls, empties and texts without letters go, all columns stay as they are."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").limit(120)
    odd = documents(spark)
    both = odd.drop("lang").withColumn("lang", F.lit(None).cast("string")).unionByName(docs, allowMissingColumns=True)
    both = both.withColumn("lang_pred", F.lit("own")).withColumn("SCORE_", F.lit(0.5)).withColumn("__row", F.lit(1))
    kept = pipeline.language(spark, both, SF)
    assert kept.columns == both.columns
    rows = kept.collect()
    texts = {r["text"] for r in rows}
    assert texts.isdisjoint({None, "", "  \t\n"}) and {r["lang_pred"] for r in rows} == {"own"}
    clean = {r["text"] for r in docs.where("n_chars > 40" if "n_chars" in docs.columns else "length(text) > 40").collect()}
    assert len(clean - texts) <= 0.05 * len(clean)
    repeated = [r for r in rows if r["doc_id"] == 10]
    assert len(repeated) in (0, 2, 3)  # rows with one id are judged by their own texts


def test_only_the_result_stays_in_the_shared_folder(spark, tmp_path):
    """The pipeline and every query that stages anything, run one after the other."""
    folder = spark.conf.get("spark.checkpoint.dir")
    staged = lambda: set(glob.glob(f"{folder}/incidentry/*"))
    before = staged()
    out = pipeline.run(spark, SF)
    assert len(staged() - before) == 1 and out.count() > 0
    discard(out)
    for name in ("op2_benchmark_decontamination", "op5_embedding_near_dedup", "op8_warc", "op12_vector_codes"):
        out = queries.QUERIES[name](spark, SF)
        assert len(staged() - before) == 1, name
        assert out.count() > 0
        discard(out)


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, None
    for number, (name, function) in enumerate(pipeline.STAGES):
        function(spark, docs, SF).write.parquet(f"{tmp_path}/{number}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{number}")
        if number < len(pipeline.STAGES) - 1:
            assert docs.columns == columns, name
        if name == "jaccard_join":
            kept = [shingles(r["text"]) for r in docs.collect()]
            assert not any(
                a and 100 * len(a & b) >= 80 * len(a | b) for i, a in enumerate(kept) for b in kept[:i]
            )
            assert docs.count() < before.count()
        if name == "suffix_array_dedup":
            seen = set()
            for r in docs.orderBy("doc_id").collect():
                assert r["n_chars"] == len(r["text"])
                strings = {r["text"].encode()[k : k + 100] for k in range(len(r["text"].encode()) - 99)}
                seen |= strings
    assert docs.columns == ["doc_id", "n_tokens", "ids", "text"]
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    assert {r["doc_id"]: r["text"] for r in docs.collect()} == texts


def test_stages_hand_small_batches_to_python(spark):
    """A session's own limit stays."""
    name, docs = "spark.sql.execution.arrow.maxBytesPerBatch", empty(spark)
    before = spark.conf.get(name, None)
    try:
        for own in (None, "3000000"):
            spark.conf.unset(name) if own is None else spark.conf.set(name, own)
            for stage, function in pipeline.STAGES:
                function(spark, docs, SF)
                assert int(spark.conf.get(name)) == int(own or pipeline.BATCH_BYTES) <= 8 << 20, stage
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def test_stages_on_odd_rows(spark):
    """Nulls, repeats and clashing columns pass through; without labels every text is rejected."""
    docs = documents(spark)
    for name, function in pipeline.STAGES:
        if name != "language_id":
            out = function(spark, docs, SF)
            assert out.count() > 0, name
            if name != "bpe":
                assert out.columns == docs.columns, name
        assert function(spark, empty(spark), SF).collect() == [], name
