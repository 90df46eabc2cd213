"""Language identification, page text, decontamination and the pipeline."""

import random
import zlib

import numpy as np
import pytest
from corpus_cases import edited, frame, rows_of, texts, words

from folioflow.llm import decontaminate as D, language_id as G
from folioflow.llm.html_text import extract_text, flat_blocks, labelled_rows, main_text, trained_tree

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = G.op10_language_id(spark, SF).toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    assert list(got["held_out"]) == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got["doc_id"]]
    held = got[got["held_out"]]
    assert (held["lang"] == held["lang_pred"]).mean() > 0.97
    assert got["score"].between(0, 1).all() and got["rejected"].mean() < 0.03


def test_language_of_odd_texts(spark):
    known = {"en": b"the and of that with this from " * 40, "fr": b"le la les des une dans pour avec " * 40}
    got = {r["doc_id"]: r for r in G.identify(frame(spark, [(1, "the with that from this and of " * 3), (2, "les dans pour avec une des " * 3), (3, None), (4, ""), (5, "12 ?!"), (6, "zz"), (None, "x")]), known).collect()}
    assert (got[1]["lang_pred"], got[2]["lang_pred"]) == ("en", "fr") and not got[1]["rejected"]
    for i in (3, 4, 5):
        assert (got[i]["lang_pred"], got[i]["score"], got[i]["rejected"]) == ("und", 0.0, True)
    assert got[6]["rejected"] and got[6]["lang_pred"] in known
    assert got[1]["item"] == "x"
    none = G.identify(frame(spark, [(1, "words")]), {}).first()
    assert (none["lang_pred"], none["score"]) == ("und", 0.0)
    assert G.Classifier({"en": b"only"}).classify("a text").score == 1.0
    empty = frame(spark, [])
    assert G.learned_from(empty) == {} and G.identify(empty, known).count() == 0


def test_dictionaries_are_bounded_and_ignore_unlabelled(spark):
    df = spark.createDataFrame([(i, f"words of number {i} " * 50, None if i % 3 == 0 else "en") for i in range(600)], "doc_id long, text string, lang string")
    found = G.learn_dictionaries(df)
    assert set(found) == {"en"} and len(found["en"]) <= G.DICTIONARY_BYTES


ARTICLE = (
    "<html><head><title>t</title><style>p{}</style><script>var a='</p><p>no</p>';</script></head><body>"
    "<nav><ul><li><a href='/a'>Home</a></li></ul></nav><!-- <p>hidden</p> --><div class='cookie-notice'>We use cookies here.</div>"
    "<article><h1>A &amp; B</h1><p><b>First&nbsp;line\n of   text.<br><p>x &lt; y &#233;</p><aside>More stories to read</aside>"
    "<form><input name=q><button>Send</button></form><p>Last.</p></article>"
    "<section class='comments'><p>I read this whole story twice and liked all of it.</p></section><footer>&copy; 2024 us</footer></body></html>"
)


def test_main_text_of_an_article():
    tree = trained_tree()
    assert main_text(ARTICLE, tree) == "A & B\nFirst line of text.\nx < y é\nLast."
    assert main_text(None, tree) == main_text("", tree) == main_text("<p></p>", tree) == ""


@pytest.mark.parametrize("attributes", ["style='overflow:hidden'", 'title="hidden gems"', "data-a = hidden", 'title="an id=menu class=ad"', "alt='role=navigation'", "aria-hidden=false"])
def test_values_of_other_attributes_hide_nothing(attributes):
    long = " ".join(["word"] * 30)
    page = f"<body><div {attributes}><article {attributes}><p>{long}</p><p>{long}</p></article></div></body>"
    assert not any(b.in_frame for b in flat_blocks(page))
    assert main_text(page, trained_tree()) == f"{long}\n{long}"


@pytest.mark.parametrize("attributes", ["hidden", "HIDDEN=''", "title=x hidden", "title='x'hidden class=a", "data-x=1 CLASS = 'a menu'", "id=nav", "role=\"navigation\"", "class='menu"])
def test_own_attributes_still_frame(attributes):
    assert all(b.in_frame for b in flat_blocks(f"<body><div {attributes}><p>Some words here</p></div></body>"))


def test_bare_pages_go_by_words_and_links():
    long = " ".join(["word"] * 30)
    page = f"<body><p><a href=/>Home</a></p><p>{long}</p><p>Yes.</p><p>{long}</p><p>{long}</p><p><a href=/1>{long}</a></p><p><a href=/2>more</a></p></body>"
    assert main_text(page, trained_tree()) == "\n".join([long, "Yes.", long, long])


def test_tree_fits_its_table_and_pages_pass_through(spark):
    rows, keep = labelled_rows()
    assert (trained_tree().predict(rows) == keep).all() and rows[:, [1, 3, 5]].any()
    df = spark.createDataFrame([(1, "u", ARTICLE, "c"), (2, None, None, "c"), (2, None, "<p", "c"), (None, "u", "x<b", "c")], "page_id long, url string, html string, text string")
    got = rows_of(extract_text(df), "page_id", "url", "text")
    assert len(got) == 4 and (1, "u", "A & B\nFirst line of text.\nx < y é\nLast.") in got
    assert extract_text(df.limit(0)).count() == 0


def test_broken_markup_ends():
    for page in ("<" * 50, "<p <p <p", "<script>x", "<!--", "<a href=\"", "</p></div>x</article>", "&amp;&#xZZ;&", "<p>" * 3000 + "x"):
        flat_blocks(page)
    assert [b.text for b in flat_blocks("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>")] == ["a", "b", "c", "d"]


def test_planted_items_are_found_and_clean_texts_left_alone(spark):
    rng = random.Random(8)
    items = [(i, words(rng, rng.randint(14, 60), "abcdefghijklmnop")) for i in range(40)]
    rows, want = [], set()
    for i, (item, text) in enumerate(items):
        share = (0, 0.02, 0.05)[i % 3]
        planted = edited(rng, text, int(share * len(text))).upper() if i % 5 == 0 else edited(rng, text, int(share * len(text)))
        rows.append((i, f"{words(rng, 50)} {planted} {words(rng, 30)}"))
        want.add((i, item))
    rows += [(1000 + i, words(rng, 150, "abcdefghijklmnop")) for i in range(60)] + [(2000, None), (2001, ""), (None, items[0][1])]
    bench = spark.createDataFrame(items + [(500, None), (501, " \n "), (None, items[1][1])], "item_id long, text string")
    got = D.find_leaks(frame(spark, rows), bench)
    pairs = {(None if r["_id"] < 0 else r["_id"], r["item_id"]) for r in got.collect()}
    assert (None, 0) in pairs and (1, None) in pairs
    pairs -= {(None, 0), (1, None)}
    assert pairs <= want and len(pairs) >= 0.95 * len(want)
    assert D.find_leaks(frame(spark, []), bench).count() == D.find_leaks(frame(spark, rows), bench.limit(0)).count() == 0


def test_reported_places_are_exact(spark):
    rng = random.Random(9)
    text = words(rng, 20)
    doc = f"{words(rng, 20)} {text} {words(rng, 20)}"
    row = D.find_leaks(frame(spark, [(1, doc)]), spark.createDataFrame([(7, text)], "item_id long, text string")).first()
    assert doc[row["start"] : row["end"]] == text and row["distance"] == 0


def test_search_distance_equals_the_table():
    rng = random.Random(2)
    for _ in range(200):
        item, text = ("".join(rng.choice("ab") for _ in range(rng.randint(1, n))) for n in (12, 30))
        row = [0] * (len(text) + 1)
        for i, x in enumerate(item, 1):
            new = [i]
            for j, y in enumerate(text, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        best = min(row)
        got = D.best_match(*[np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in (item, text)])
        assert got == (best, row.index(best))


def test_recall_within_the_threshold():
    rng = random.Random(4)
    items = [(i, words(rng, rng.randint(20, 60), "abcdefghijklmnop")) for i in range(60)]
    index = D.ItemIndex(items, D.EDIT_SHARE)
    for share, least in ((0.05, 0.97), (0.08, 0.9)):
        found = 0
        for i, text in items:
            doc = f"{words(rng, 20)} {edited(rng, text, int(share * len(text)))} {words(rng, 20)}"
            chars = np.frombuffer(doc.encode("utf-32-le"), np.uint32)
            found += any(index.names[m[1]] == i for m in index.search(chars, np.array([0, len(chars)])))
        assert found / len(items) >= least


def points(text):
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def found_in(index, doc):
    return [m[1:] for m in index.search(points(doc), np.array([0, len(doc)]))]


def test_edits_gathered_at_the_head_are_found():
    rng = random.Random(11)
    items = [(i, words(rng, rng.randint(36, 60), "abcdefghijklmnop")) for i in range(60)]
    index = D.ItemIndex(items, D.EDIT_SHARE)
    for i, text in items:
        quarter = len(text) // 4
        copy = edited(rng, text[:quarter], len(text) // 10) + text[quarter:]
        assert i in [m[0] for m in found_in(index, f"{words(rng, 20)} {copy} {words(rng, 20)}")]


def test_full_tenth_equals_brute_force():
    rng = random.Random(12)
    items = [(i, words(rng, rng.randint(2, 50), "abcdefghijklmnop")) for i in range(60)]
    items += [(60, "".join(rng.choice("abcdefgh") for _ in range(200))), (61, "語彙検索文書" * 5), (62, "a" * 40), (63, "q")]
    index = D.ItemIndex(items, D.EDIT_SHARE)
    for i, text in items:
        doc = f"{words(rng, 15)} {edited(rng, text, len(text) // 10)} {words(rng, 15)} {'a' * 60}"
        want = []
        for j, other in items:
            distance, end = D.best_match(points(other), points(doc))
            if distance <= len(other) // 10:
                _, length = D.best_match(points(other)[::-1], points(doc)[:end][::-1])
                want.append((j, distance, end - length, end))
        assert i in [w[0] for w in want] and found_in(index, doc) == want


def test_an_edit_in_every_long_word_and_text_without_blanks():
    rng = random.Random(13)
    text = words(rng, 50, "abcdefghijklmnop")
    split = text.split()
    for at in sorted(range(len(split)), key=lambda a: -len(split[a]))[:8]:
        split[at] = split[at][:1] + "z" + split[at][2:]
    url = "https://example.org/" + "".join(rng.choice("abcdefgh") for _ in range(80))
    index = D.ItemIndex([(0, text), (1, url)], D.EDIT_SHARE)
    assert [m[0] for m in found_in(index, f"{words(rng, 9)} {' '.join(split)} {words(rng, 9)}")] == [0]
    assert found_in(index, f"see {url[:50]}Z{url[51:]} there") == [(1, 1, 4, 104)]


def test_items_cut_off_at_the_borders_of_a_text_are_found():
    rng = random.Random(14)
    items = [(i, words(rng, rng.randint(36, 60), "abcdefghijklmnop")) for i in range(60)]
    items += [(100, f"{items[0][1][:60]} anchoringword {items[1][1][:60]} anchoringword {items[2][1][:60]}")]
    index = D.ItemIndex(items, D.EDIT_SHARE)
    docs, want = [], []
    for i, (_, text) in enumerate(items):
        k = len(text) // 10
        for part in (text, text[k:], text[: len(text) - k]):
            want.append((len(docs), i, len(text) - len(part), 0, len(part)))
            docs.append(part)
    edges = np.cumsum([0, *map(len, docs)])
    assert index.search(points("".join(docs)), edges) == want


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Documents before the first stage and after each, on the small tables with odd rows."""
    import corpus_pipeline as C

    root = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    odd = frame(spark, [(100_000 + (i or 0), t) for i, t in texts()]).select(*docs.columns)
    docs = docs.unionByName(odd.select(*[odd[c].cast(docs.schema[c].dataType) for c in docs.columns]))
    out = []
    for name, stage in [("documents", lambda s, d, _: docs), *C.STAGES]:
        stage(spark, docs, SF).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
        out.append((name, docs))
    return out


def test_stages_keep_columns_and_only_remove(stages):
    columns = stages[0][1].columns
    ids = None
    for name, docs in stages:
        if name != "sentencepiece":
            assert docs.columns == columns, name
        now = {r[0] for r in docs.select("doc_id").collect()}
        assert ids is None or now <= ids
        ids = now
    assert 0.85 * stages[0][1].count() < len(ids)


def test_stages_decide_as_their_operators_by_brute_force(spark, stages):
    from test_llm_duplicates import kept_lines, linked

    import corpus_pipeline as C

    by_name = dict(stages)
    pairs = {n: [(r["doc_id"], r["text"]) for r in d.select("doc_id", "text").collect()] for n, d in stages if n != "sentencepiece"}
    model = G.Classifier(G.learned_from(by_name["documents"]))
    want = {i for i, t in pairs["documents"] if t and model.classify(t).score >= G.MIN_MARGIN}
    assert {i for i, _ in pairs["language_id"]} == want
    near = linked(pairs["line_dedup"][:150], C.NEAR)
    part = frame(spark, pairs["line_dedup"][:150])
    assert sorted(r[0] for r in C.ngram_join(spark, part, SF).collect()) == sorted({c for _, n, c in near} | {i for i, n, _ in near if not n})
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    held = {i for i, t in pairs["ngram_jaccard_join"] if any(x in t for x in items)}
    gone = {i for i, _ in pairs["ngram_jaccard_join"]} - {i for i, _ in pairs["benchmark_decontamination"]}
    assert held and held <= gone and len(gone) <= len(held) + 5
    assert {r["doc_id"] for r in by_name["sentencepiece"].collect()} == {i for i, _ in pairs["benchmark_decontamination"]}
    few = pairs["language_id"][:40]
    want = {i: t for i, t, _ in kept_lines([(i, t) for i, t in few], 2, 20) if t.strip()}
    got = {r["doc_id"]: r["text"] for r in C.line_dedup(spark, frame(spark, few), SF).collect()}
    assert got == want


def test_near_duplicates_by_component_not_by_id(spark):
    import corpus_pipeline as C

    rng = random.Random(15)
    a, b, c, d, e = (words(rng, 60) for _ in range(5))
    rows = [(None, a), (None, b), (None, b), (1, b + " more"), (5, c), (5, d), (6, c), (7, d), (8, e), (9, e), (None, None), (10, ""), (10, " ")]
    got = rows_of(C.ngram_join(spark, frame(spark, rows), SF), "doc_id", "text")
    assert got == sorted([(None, a), (None, b), (5, c), (5, d), (8, e), (None, None), (10, ""), (10, " ")], key=repr)


def test_queries_are_registered_with_their_sql():
    import __spark_entry__ as entry
    from folioflow.llm.queries import ORACLE_SQL, QUERIES

    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())
