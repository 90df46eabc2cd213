"""Token files and merge-dropout: against the libraries, exact round trips."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from corpus_cases import frame, rows_of, texts

from folioflow.llm import merge_dropout as M
from folioflow.llm.token_files import TokenFile, _open, id_type, read_documents, word_encoder, write_token_files

public_tokenizers = pytest.importorskip("public_tokenizers")
ODD = ["", " ", "  a  b\n\n\nc\t é 　x \x00 ﬁ ½ ", "▁▁x", "x" * 500, "日本語 テスト 😀", "a\nb", "\n\n"]


def ordered(rows):
    """Nulls first, then by id, then by the hash the operator sorts by (left open here)."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


@pytest.mark.parametrize("file_documents", [5, 1000])
def test_files_hold_what_the_tokenizer_says(spark, tmp_path, file_documents):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [r for r in texts() if r[0] is not None and r[0] != 80] + [(900 + i, t) for i, t in enumerate(ODD)]
    data = write_token_files(
        frame(spark, rows), lambda: word_encoder(path), f"file:{tmp_path}/tokens", sequence=64,
        batch_sequences=4, file_documents=file_documents,
    )
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    start, want = 0, []
    for i, t in ordered(rows):
        ids = plain.encode(t or "", add_special_tokens=False).ids + [1]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, read_documents(data).collect())) == sorted(want)


def test_special_tokens_in_a_text_are_the_library_s():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    held = ["a <|endoftext|> b", "<|startoftext|>word<|endoftext|>\nmore", "x<|endoftext|>y <|endoftext|><|endoftext|>  z", "<|END|> <|endoftext"]
    ids, counts = word_encoder(path).encode(held)
    plain = Tokenizer.from_file(path)
    want = [plain.encode(t, add_special_tokens=False).ids for t in held]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])


def test_repeated_and_null_ids_are_all_there(spark, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    data = write_token_files(frame(spark, texts()), lambda: word_encoder(path), f"{tmp_path}/tokens")
    got = sorted(read_documents(data).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [i for i, _ in ordered(texts())]
    assert [r["start"] for r in got] == np.r_[0, np.cumsum([r["n_tokens"] for r in got])][:-1].tolist()


def test_an_empty_table_gives_no_rows(spark, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    data = write_token_files(frame(spark, []), lambda: word_encoder(path), f"{tmp_path}/none")
    assert read_documents(data).count() == 0


def test_sequences_are_views_with_masks(spark, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    data = write_token_files(
        frame(spark, texts()), lambda: word_encoder(path), f"{tmp_path}/tokens", sequence=128, batch_sequences=3, file_documents=1000
    )
    names = [r["file"] for r in data.index.select("file").distinct().collect()]
    total = data.index.agg({"n_tokens": "sum"}).first()[0]
    held = 0
    for name in names:
        file = TokenFile(_open(f"{tmp_path}/tokens/{name}"))
        n_rows = sum(file.reader.get_batch(k).num_rows for k in range(file.reader.num_record_batches))
        for number in range(n_rows):
            ids, mask = file.row(number)
            assert len(ids) == len(mask) == 128 and not ids.flags.owndata
            kept = mask.to_numpy(zero_copy_only=False)
            assert (np.diff(kept.astype(int)) <= 0).all() and not ids[~kept].any()
            held += kept.sum()
        assert pa.types.is_fixed_size_list(file.reader.schema.field("input_ids").type)
    assert held == total
    assert id_type(49_408) == np.uint16 and id_type(100_000) == np.uint32


@pytest.fixture(scope="module")
def pieces():
    return M.load_pieces(M.model_path())


def plain_agenda(pieces, unit, key, encoder):
    """Merge-dropout written out: scan for the best open candidate until none is left."""
    symbols = [(int(pieces.char_id[ord(c)]), i, i + 1) for i, c in enumerate(unit)]
    while True:
        best = None
        for at, ((a, s, m), (b, _, e)) in enumerate(zip(symbols, symbols[1:])):
            merge = pieces.pairs.get(a * pieces.size + b) if a >= 0 and b >= 0 else None
            if merge is None:
                continue
            place = [np.array([v]) for v in (s, m, e)]
            if encoder.limit and encoder.skipped(np.array([key], np.uint64), *place)[0]:
                continue
            if best is None or merge[0] < best[0]:
                best = (merge[0], at, merge[1])
        if best is None:
            return [s[0] for s in symbols]
        _, at, merged = best
        symbols[at : at + 2] = [(merged, symbols[at][1], symbols[at + 1][2])]


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.6, 1.0])
def test_segments_equal_the_plain_agenda(pieces, dropout):
    encoder = M.MergeDropout(pieces, dropout)
    units = [" hello", " international", "ation", " übermäßig", "x" * 60, "  word"]
    keys = encoder.keys_of(np.arange(len(units)) % encoder.variants)
    symbol, counts = encoder.segment(units, keys)
    ends = np.r_[0, np.cumsum(counts)]
    for i, unit in enumerate(units):
        got = symbol[ends[i] : ends[i + 1]]
        assert np.where(got < 0, -1, got).tolist() == plain_agenda(pieces, unit, keys[i], encoder)


def test_without_dropout_the_ids_are_the_library_s(pieces):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=M.model_path())
    all_texts = [t or "" for _, t in texts()] + [t for t in ODD if "▁" not in t]
    ids, counts = M.MergeDropout(pieces, 0.0).encode(all_texts, np.arange(len(all_texts)))
    ends = np.r_[0, np.cumsum(counts)]
    for i, t in enumerate(all_texts):
        assert ids[ends[i] : ends[i + 1]].tolist() == model.encode(t)


def test_dropout_varies_and_decodes_without_loss(spark):
    rows = texts() + [(900 + i, t) for i, t in enumerate(ODD)]
    path = M.model_path()
    df = frame(spark, rows).withColumnRenamed("item", "decoded")
    a = M.decode_pieces(M.encode_pieces(df, path, 0.3, seed=1), path)
    assert rows_of(a, "doc_id", "decoded") == sorted([(i, t or "") for i, t in rows], key=repr)
    assert set(df.columns) <= set(a.columns)
    again = M.encode_pieces(df.repartition(5), path, 0.3, seed=1)
    other = M.encode_pieces(df, path, 0.3, seed=2)
    assert rows_of(a, "doc_id", "text", "piece_ids") == rows_of(again, "doc_id", "text", "piece_ids")
    assert rows_of(a, "doc_id", "text", "piece_ids") != rows_of(other, "doc_id", "text", "piece_ids")
    assert M.decode_pieces(M.encode_pieces(df.limit(0), path), path).count() == 0


def test_one_word_takes_several_segmentations(pieces):
    ids, counts = M.MergeDropout(pieces, 0.3).encode([" ".join(["international"] * 40)], np.array([1]))
    units = " ".join(map(str, ids.tolist()))
    whole, _ = M.MergeDropout(pieces, 0.0).encode([" ".join(["international"] * 40)], np.array([1]))
    assert len(ids) > len(whole) and len(set(units.split())) > len(set(whole.tolist()))


def test_the_store_never_changes_the_result(pieces, monkeypatch):
    all_texts = [t or "" for _, t in texts()]
    keys = np.arange(len(all_texts))
    want, _ = M.MergeDropout(pieces, 0.2).encode(all_texts, keys)
    monkeypatch.setattr(M, "CACHE_WORDS", 50)
    small = M.MergeDropout(pieces, 0.2)
    got = np.concatenate([small.encode([t], keys[i : i + 1])[0] for i, t in enumerate(all_texts)])
    assert np.array_equal(got, want)


@pytest.mark.parametrize("dropout", [0.1, 0.5, 1.0])
def test_every_word_draws_its_merges_by_document_and_place(pieces, dropout):
    """The store's results are those of an agenda of its own for each word of each text."""
    all_texts = [t or "" for _, t in texts()] + ODD + ["international " * 300, "y" * 45 + " übermäßig"]
    keys = np.arange(len(all_texts)) * 7
    encoder = M.MergeDropout(pieces, dropout)
    ids, counts = encoder.encode(all_texts, keys)
    ends = np.r_[0, np.cumsum(counts)]
    for i, text in enumerate(all_texts):
        units = M._UNIT.findall(" " + text) if text else []
        drawn = M.mixed(np.full(len(units), keys[i], np.uint64) ^ M.mixed(np.arange(len(units), dtype=np.uint64) + encoder.seed))
        want, _ = encoder._with_bytes(*encoder.segment(units, drawn)) if units else (np.zeros(0, np.int64), None)
        assert np.array_equal(ids[ends[i] : ends[i + 1]], want)


def test_a_merge_is_dropped_at_its_rate_everywhere(pieces):
    encoder = M.MergeDropout(pieces, 0.1)
    ids, counts = encoder.encode([" ".join(["international"] * 50)] * 200, np.arange(200))
    kinds = {tuple(x.tolist()) for x in np.split(encoder.store[: encoder.used], np.cumsum(encoder.states["count"][: encoder.n_states])[:-1])}
    assert len(kinds) > 8
    for word in "aeio":
        whole, n = M.MergeDropout(pieces, 0.0).encode([word], np.array([0]))
        got, _ = encoder.encode([word] * 4000, np.arange(4000))
        assert len(whole) == 1 and abs((got == whole[0]).sum() / 4000 - 0.9) < 0.02
