import sentencepiece
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as P
from strata.llm.decontaminate import contaminated_pairs
from strata.llm.quality import score_quality
from strata.llm.queries import table
from strata.llm.secret_scan import scan_secrets
from tests.llm.test_pipeline_near import kept

BIG = "/root/testdata/sf0.01"


def test_stages_in_order_and_registered():
    assert [f.__name__ for _, f in P.STAGES] == ["quality", "near_duplicates", "decontaminate", "redact", "tokens"]
    assert entry.queries()["pipeline"] is P.run and "pipeline" not in entry.oracle_sql()
    names = entry.queries()
    assert all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11))


def test_run_equals_the_decisions_of_the_operators(spark):
    """Brute force: every decision taken by hand on collected rows."""
    rows = {r["doc_id"]: r["text"] for r in table(spark, BIG, "documents").collect()}

    def frame():
        return spark.createDataFrame(list(rows.items()), "doc_id long, text string")

    poor = score_quality(table(spark, BIG, "documents"), table(spark, BIG, "labels")).where("predicted = 0")
    for r in poor.collect():
        del rows[r["doc_id"]]
    stays = kept(rows)  # the stage's own rule, by brute force
    rows = {i: t for i, t in rows.items() if i in stays}
    for i in {r["doc_id"] for r in contaminated_pairs(frame(), table(spark, BIG, "benchmark")).collect()}:
        del rows[i]
    for r in scan_secrets(frame()).where(F.size("secret_spans") > 0).collect():
        text = rows[r["doc_id"]]
        for s in sorted(r["secret_spans"], key=lambda s: -s["start"]):
            text = text[: s["start"]] + f"[{s['kind'].upper()}]" + text[s["end"] :]
        rows[r["doc_id"]] = text
    library = sentencepiece.SentencePieceProcessor(model_file=P.PIECES)
    found = {r["doc_id"]: r["token_ids"] for r in P.run(spark, BIG).collect()}
    assert set(found) == set(rows)
    # overlapping secrets are merged by the operator, so compare texts without them exactly
    plain = [i for i, t in rows.items() if "[" not in t]
    assert len(plain) > 300
    assert all(found[i] == library.encode(rows[i]) for i in plain)


def test_odd_rows_pass_every_stage(spark, odd_documents, no_documents):
    for docs, least in ((odd_documents, 1), (no_documents, 0)):
        for k, (_, stage) in enumerate(P.STAGES):
            docs = stage(spark, docs, "/root/testdata/sf0.001")
            if k < len(P.STAGES) - 1:
                assert docs.columns == list(P.COLUMNS)
        assert docs.count() >= least
