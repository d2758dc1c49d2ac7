"""The pipeline stage by stage, each against a plain version of its decision."""

import corpus_pipeline
from ratewright.llm import pieces, quality, secrets
from ratewright.storage import materialise
from tests.llm.test_joins import plain_join


def test_stages(spark, sf_dir, documents):
    docs, kept = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        out = materialise(stage(spark, docs, sf_dir), name)
        kept[name] = (docs.collect(), out.collect())
        if name != "pieces":
            assert out.columns == documents.columns and out.dtypes == documents.dtypes
        docs = out

    before, after = kept["quality"]
    machine = quality.fit(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    good = {r["doc_id"] for r in quality.score(documents, machine).collect() if r["predicted"]}
    assert {r["doc_id"] for r in after} == good and 0 < len(after) < len(before)

    before, after = kept["near_copies"]
    by_row = [eval(r) for r in plain_join([(r["doc_id"], r["text"]) for r in before])]
    assert sorted(r["doc_id"] for r in after) == sorted({c for _, _, c in by_row})

    before, after = kept["secrets"]
    changed = {r["doc_id"]: r for r in after}
    assert len(after) == len(before)
    for r in before:
        spans = secrets.find(r["text"], secrets.vocabulary())
        assert changed[r["doc_id"]]["text"] == secrets.redacted(r["text"], spans, "[secret]")
        assert changed[r["doc_id"]]["n_chars"] == len(changed[r["doc_id"]]["text"])

    before, after = kept["mix"]
    assert {r["doc_id"] for r in after} <= {r["doc_id"] for r in before}
    total = sum(len(r["text"].split()) for r in before)
    assert 0.9 * total < sum(len(r["text"].split()) for r in after) <= total

    before, after = kept["pieces"]
    model = pieces.pieces(pieces.model_file())
    assert sorted((r["doc_id"], model.decode(r["ids"])) for r in after) == sorted((r["doc_id"], r["text"]) for r in before)


def test_odd_rows_pass_every_stage(spark, sf_dir, odd, odd_rows, make):
    for docs in (make(odd_rows), make([])):
        for _, stage in corpus_pipeline.STAGES:
            docs = materialise(stage(spark, docs, sf_dir), "odd")
        assert docs.columns[:2] == ["doc_id", "source"]


def test_run_gives_the_last_stage(spark, sf_dir):
    df = corpus_pipeline.run(spark, sf_dir)
    assert df.columns == ["doc_id", "source", "ids", "n_ids", "exact"] and df.count() > 0


def test_columns_of_any_name_come_through(spark, sf_dir, make, odd_rows):
    """Every name that the stages' operators use inside, on the table itself: the stages give what they give without."""
    from pyspark.sql import functions as F

    names = (
        "row doc key node n rare one two size place turn finish target upto mix_row mix_finish jaccard_row keep label part "
        "source_size copies held_out score"
    ).split()
    plain = extra = materialise(make(odd_rows).repartition(2), "plain")
    extra = materialise(plain.withColumns({c: F.lit(f"of {c}") for c in names} | {"a.b": F.lit(5)}), "extra")
    for name, stage in corpus_pipeline.STAGES:
        plain, extra = (materialise(stage(spark, d, sf_dir), name) for d in (plain, extra))
        shared = plain.columns
        assert sorted(map(str, extra.select(shared).collect())) == sorted(map(str, plain.collect()))
        if name != "pieces":
            assert set(extra.columns) == {*shared, *names, "a.b"}
            assert all(r[c] == f"of {c}" for r in extra.collect() for c in names)


def test_without_a_declared_length(spark, sf_dir, documents):
    docs = materialise(documents.drop("n_chars"), "short")
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
        if name != "pieces":
            assert docs.columns == ["doc_id", "text", "lang", "source"]
    assert docs.count() > 0
