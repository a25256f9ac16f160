import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import plain
import pytest
from pyspark.sql import functions as F
from recordloom.llm import packing, sentencepiece_codec
from recordloom.llm.queries import sentencepiece_file, tokenizer_file

ODD = ["a   b", "a  b", " \n x", "x \n\n y", "<|endoftext|> a", "a  <|endoftext|>", "", " ", "\t a", "a \x1c b", "it's 'll don't", "é  b  c", "a \x85 b", "x" * 600]


def test_stretches_give_the_ids_of_the_whole():
    encoder = packing.ChunkEncoder.of(tokenizer_file())
    assert [encoder.encode(t) for t in ODD] == encoder.by_tokenizers(ODD)


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_plan_holds_every_piece(seed):
    rng = np.random.default_rng(seed)
    lengths = [rng.integers(1, 2048, 4_000), rng.integers(700, 1_300, 3_000), np.minimum(rng.geometric(0.003, 5_000), 2047)][seed]
    histogram = Counter(lengths.tolist())
    runs = packing.plan_sequences(histogram)
    held = Counter()
    for parts, n in runs:
        assert sum(parts) <= packing.SEQUENCE and n > 0
        for x in parts:
            held[x] += n
    assert held == histogram
    decreasing = sum(n for _, n in packing._best_fit([], sorted(histogram.items(), reverse=True), packing.SEQUENCE))
    assert sum(n for _, n in runs) <= 1.01 * decreasing


def test_packing(small, hard, empty):
    encoder = packing.ChunkEncoder.of(tokenizer_file())
    for frame, source in ((small[0], small[1]), (hard, plain.HARD)):
        rows = packing.pack_documents(frame, tokenizer_file(), with_ids=True).collect()
        want, total = Counter(), 0
        for i, text in source:
            ids = np.frombuffer(encoder.by_tokenizers([text or ""])[0] + b"\0" * 4, "<u4")
            total += len(ids)
            start = piece = 0
            while start < len(ids):
                n = (len(ids) - start) % 2048 or 2048
                want[i, piece, start, n, zlib.crc32(ids[start : start + n].tobytes())] += 1
                start, piece = start + n, piece + 1
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
        assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)
        placed = defaultdict(list)
        for r in rows:
            placed[r.sequence_id].append((r.offset, r.length))
        for parts in placed.values():
            at = 0
            for offset, n in sorted(parts):
                assert offset == at
                at += n
            assert at <= 2048
        assert len(placed) <= 1.03 * total / 2048 + 2
    assert packing.pack_documents(empty, tokenizer_file()).collect() == []


def test_sentencepiece(small, hard, empty):
    message = sentencepiece_file()
    rows = sentencepiece_codec.encode_documents(small[0], message).collect()
    assert all(r.parity and r.round_trip and r.n_ids == len(r.ids) for r in rows) and len(rows) == len(small[1])
    encoded = sentencepiece_codec.encode_documents(hard, message)
    rows = encoded.collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in plain.HARD) and all(r.parity for r in rows)
    texts = dict(plain.HARD)
    got = {r.doc_id: r.text for r in sentencepiece_codec.decode_documents(encoded, message).collect()}
    assert all(got[i] == (texts[i] or "") for i in texts)
    assert sentencepiece_codec.encode_documents(empty, message).collect() == []


def test_odd_texts_keep_parity():
    import sentencepiece

    message = sentencepiece_file()
    codec = sentencepiece_codec.Codec.of(message)
    known = sentencepiece.SentencePieceProcessor(model_proto=message)
    odd = [*ODD, "▁x ▁▁ y", "<s> </s> <unk> <0x41>", "  lead", "trail  "]
    assert [x.tolist() for x in codec.encode(odd)] == known.encode(odd)


@pytest.mark.parametrize("options", [
    {"byte_fallback": True},
    {"byte_fallback": False},
    {"byte_fallback": True, "normalization_rule_name": "identity", "remove_extra_whitespaces": False},
    {"byte_fallback": True, "add_dummy_prefix": False},
])
def test_unigram_models_keep_parity(small, options):
    """Models trained here: scores, byte fallback and normaliser give the library's ids on every line, tie and odd text."""
    import io

    import sentencepiece

    texts = [t for _, t in small[1] if t]
    lines = [x for t in texts for x in t.split("\n") if x.strip()]
    message = io.BytesIO()
    sentencepiece.SentencePieceTrainer.train(
        sentence_iterator=iter(lines[:4000]), model_writer=message, vocab_size=700, model_type="unigram", character_coverage=0.995,
        minloglevel=2, num_threads=1, **options,
    )
    codec = sentencepiece_codec.Codec(message.getvalue())
    known = sentencepiece.SentencePieceProcessor(model_proto=message.getvalue())
    more = ["▁x ▁▁ y", "<s> </s> <unk> <0x41>", "  lead", "trail  ", "ﬁ ①② Ünïcode", "日本語日本 語", "### ## #### $$$ $$ $", "ＡＢＣ é", "\u200b a\u200bb", "que quequ"]
    odd = [*lines, *texts, *ODD, *more, *[t or "" for _, t in plain.HARD if len(t or "") < 10_000]]
    assert codec.spec.model == sentencepiece_codec.UNIGRAM
    assert [x.tolist() for x in codec.encode(odd)] == known.encode(odd)
    assert any(codec.unigrams.tied(x) for x in ("▁###", "▁$$$")) or not codec.tied


def test_pipeline_equals_its_plain_version(spark, small):
    """Stage by stage on the same documents: what stays, and every token of it in the sequences."""
    docs, pairs = small
    clash = ["_found", "_score", "_words", "_known", "_lang_pred", "_sha", "_id", "digest", "row", "kept", "id"]
    docs = docs.limit(150).withColumns({c: F.lit(1) for c in clash}).cache()
    texts = {r.doc_id: r.text for r in docs.collect()}
    held = docs
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        held = stage(spark, held, "")
        seen.append((name, {r[0] for r in held.select("doc_id").collect()}))
        if name != "best_fit_packing":
            assert held.columns == docs.columns
    stays = {i for i, t in texts.items() if any(c.isalpha() for c in t or "")}
    assert seen[0][1] == stays
    first = {}
    for i in sorted(stays):
        first.setdefault(" ".join(plain.words(texts[i])), i)
    assert seen[1][1] <= stays and len(seen[1][1]) >= len(first)
    sets, links = plain.near_links([(i, texts[i]) for i in seen[1][1]])
    root = plain.roots(list(sets), links)
    assert seen[2][1] == {i for i in root if root[i] == i} == seen[3][1] == seen[4][1]


def test_pipeline_on_an_empty_table(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
