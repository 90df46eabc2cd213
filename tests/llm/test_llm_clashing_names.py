"""Input columns named like the operators' own helper columns pass through untouched."""

from corpus_cases import frame, rows_of, texts
from pyspark.sql import functions as F

from folioflow.llm import language_id as G, merge_dropout as M
from folioflow.llm.common import free_name
from folioflow.llm.html_text import extract_text

SF = "/root/testdata/sf0.001"


def with_clashes(df, *names):
    return df.select("*", *[F.lit(f"mine {n}").alias(n) for n in names])


def test_free_name_ignores_case():
    assert free_name("_text", ["text"]) == "_text"
    assert free_name("_text", ["_TEXT", "__text"]) == "___text"


def test_pieces_with_helper_names(spark):
    path = M.model_path()
    plain = frame(spark, texts())
    clashing = with_clashes(plain, "_text", "_key", "_ids")
    got = M.decode_pieces(M.encode_pieces(clashing, path, 0.3, seed=1), path)
    want = M.decode_pieces(M.encode_pieces(plain, path, 0.3, seed=1), path)
    assert rows_of(got, "doc_id", "piece_ids", "decoded") == rows_of(want, "doc_id", "piece_ids", "decoded")
    assert {r[0] for r in got.select("_text").collect()} == {"mine _text"}
    assert {r[0] for r in got.select("_ids").collect()} == {"mine _ids"}


def test_pages_with_helper_names(spark):
    html = "<html><body><article><p>" + "Some words of the story here. " * 8 + "</p></article></body></html>"
    pages = spark.createDataFrame([(1, "u", html), (2, None, None)], "page_id long, url string, html string")
    got = rows_of(extract_text(with_clashes(pages, "_html")), "page_id", "text", "_html")
    want = rows_of(extract_text(pages), "page_id", "text")
    assert [g[:2] for g in got] == want and {g[2] for g in got} == {"mine _html"}


def test_languages_with_helper_names(spark):
    known = G.learned_from(spark.read.parquet(f"{SF}/documents.parquet"))
    plain = frame(spark, texts())
    got = rows_of(G.identify(with_clashes(plain, "_verdict"), known), "doc_id", "lang_pred", "score", "rejected", "_verdict")
    want = rows_of(G.identify(plain, known), "doc_id", "lang_pred", "score", "rejected")
    assert [g[:4] for g in got] == want and {g[4] for g in got} == {"mine _verdict"}


def test_pipeline_stages_with_helper_names(spark):
    import corpus_pipeline as C

    docs = frame(spark, texts() + [(9_001, "one two three four five six seven"), (9_002, "one two three four five six seven")])
    for name, stage in C.STAGES[2:4]:
        got = stage(spark, with_clashes(docs, "_row_id", "_row_hash"), SF)
        want = stage(spark, docs, SF)
        assert rows_of(got, "doc_id", "text") == rows_of(want, "doc_id", "text"), name
        assert {r[0] for r in got.select("_row_id").collect()} <= {"mine _row_id"}, name
