import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_model_pb2 as pb
from tokenizers import Tokenizer

from candlewick.llm.queries import op7_token_counts, op8_sentencepiece, tokenizer_path
from candlewick.llm.sentencepiece_codec import (Segments, decode, encode, encode_checked, parse_model, rebuild, restored,
                                                splits)
from candlewick.llm.token_count import Agreement, count_tokens, _count, _Lengths
from tests.conftest import SF001
from tests.llm.helpers import TEXTS, edge_docs, empty_docs

ODD = ["don't we'll", "a  b   c \n\n d\t\te ", "12345 ½²", "\x1c\x1f\x85\xa0 x", "naïve Ünïcode – “quoted” …", "عربي 中文 ไทย",
       "<|endoftext|><|endoftext|> x<|endoftext|>", "'s 'T it'S", "   ", "🙂🙂 family 👨‍👩‍👧", "▁x▁▁y", "<s></s><unk><0x41>"]


def test_counts_equal_the_library(spark):
    got = {r.doc_id: r for r in op7_token_counts(spark, SF001).collect()}
    tok = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    for r in spark.read.parquet(f"{SF001}/documents.parquet").collect():
        n = len(tok.encode(r.text or "", add_special_tokens=False))
        g = got[r.doc_id]
        assert (g.n_bytes, g.n_tokens, g.over_limit) == (len((r.text or "").encode()), n, n > 512)


@pytest.mark.parametrize("name,cache", [("byte_bpe_50k.json", 400_000), ("byte_bpe_50k.json", 2), ("word_bpe_49k.json", 10)])
def test_odd_texts_small_cache_and_edges(spark, name, cache):
    docs = edge_docs(spark).select("doc_id", "text", "fp").union(
        spark.createDataFrame([(100 + i, t, "x") for i, t in enumerate(ODD)], "doc_id long, text string, fp string"))
    tok = Tokenizer.from_file(tokenizer_path(name))
    tok.no_truncation()
    got = count_tokens(docs, tokenizer_path(name), cache_entries=cache).collect()
    assert len(got) == len(TEXTS) + len(ODD)
    for r in got:
        assert r.n_tokens == len(tok.encode(r.text or "", add_special_tokens=False)), r.text
    assert count_tokens(empty_docs(spark), tokenizer_path(name)).count() == 0


SCRIPTS = ["Съешь ещё этих мягких булок, да выпей чаю 2024!", "Ξεσκεπάζω την ψυχοφθόρα βδελυγμία.", "نص عربي ١٢٣ مع أرقام",
           "敏捷的棕色狐狸 跳过\u3000懒狗。一二三", "สวัสดีชาวโลก ๑๒๓", "हिन्दी में पाठ १२३ है", "שלום עולם", "こんにちは、世界 ①②",
           "한국어 문장\u2028입니다 \u00a0 x", "e\u0301 o\u0308 \u200d\u200b zero", "Ⅻ ½ 𝟘𝟙 𝓪𝓫 😀👩‍👩‍👧"]


def test_every_script_goes_through_the_lookup():
    """Counts are the library's though no text is given to it whole, but for characters that the engines class apart."""
    tok = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    agreement, cache = Agreement(tok), _Lengths(tok, {}, 1000)
    assert all(map(agreement.on, SCRIPTS))
    expected = [len(tok.encode(t, add_special_tokens=False)) for t in SCRIPTS]
    assert _count(SCRIPTS, None, cache, agreement, ["<|endoftext|>"]) == expected
    apart = [c for c in map(chr, [*range(0x80, 0xd800), *range(0xe000, 0x1f000)]) if not agreement.same_class(c)]
    assert len(apart) < 3000
    for c in apart[:50]:
        t = f"before {c}{c} after{c}1"
        assert not agreement.on(t)
        assert _count([t], tok, cache, agreement, []) == [len(tok.encode(t, add_special_tokens=False))]


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_counts_of_any_text(text):
    tok = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    got = _count([text], tok, _Lengths(tok, {}, 1000), Agreement(tok), ["<|endoftext|>"])
    assert got == [len(tok.encode(text, add_special_tokens=False))]


def test_sentencepiece_query(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = op8_sentencepiece(spark, SF001).collect()
    assert len(got) == len(text)
    for r in got:
        assert r.ids == sp.encode(text[r.doc_id]) and r.n_tokens == len(r.ids) and r.round_trip and r.parity


def test_sentencepiece_edges(spark):
    model = tokenizer_path("piece_bpe_32k.model")
    docs = edge_docs(spark).drop("ids").union(spark.createDataFrame(
        [(100 + i, t, *["x"] * 15) for i, t in enumerate(ODD)], edge_docs(spark).drop("ids").schema))
    got = encode_checked(docs, model).collect()
    assert len(got) == len(TEXTS) + len(ODD)
    for r in got:
        if r.text is None:
            assert r.encoded.ids is None and r.encoded.parity is None
        else:
            assert r.encoded.parity and r.encoded.round_trip, r.text
    assert [r.encoded.ids for r in got if r.text == ""] == [[]]
    back = decode(encode(docs, model), model).collect()
    assert all(r.decoded == (r.text if r.text is None else r.text.replace("▁", " ")) for r in back)
    assert encode_checked(empty_docs(spark), model).count() == 0


def small_model(byte_fallback, squeeze, prefix):
    """A hand-made unigram model (nothing is trained)."""
    m = pb.ModelProto()
    m.trainer_spec.model_type, m.trainer_spec.byte_fallback = 1, byte_fallback
    m.trainer_spec.unk_id, m.trainer_spec.bos_id, m.trainer_spec.eos_id, m.trainer_spec.pad_id = 0, 1, 2, -1
    m.normalizer_spec.name, m.normalizer_spec.add_dummy_prefix = "identity", prefix
    m.normalizer_spec.remove_extra_whitespaces, m.normalizer_spec.escape_whitespaces = squeeze, True
    for p, s, t in [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3)] + [
            (f"<0x{i:02X}>", 0, 6) for i in range(256 if byte_fallback else 0)] + [
            ("▁", -3, 1), ("a", -4, 1), ("b", -4.5, 1), ("c", -5, 1), ("ab", -5.1, 1), ("▁a", -4.2, 1), ("abc", -6.5, 1),
            ("bc", -5.2, 1), ("▁ab", -5.9, 1), ("\n", -7, 1)]:
        m.pieces.add(piece=p, score=s, type=t)
    return m.SerializeToString()


@pytest.mark.parametrize("byte_fallback", [True, False])
@pytest.mark.parametrize("squeeze", [True, False])
@pytest.mark.parametrize("prefix", [True, False])
def test_unigram_rebuild(byte_fallback, squeeze, prefix):
    raw = small_model(byte_fallback, squeeze, prefix)
    sp, tok = sentencepiece.SentencePieceProcessor(model_proto=raw), rebuild(parse_model(raw))
    for t in ["abc", "a bc  abc ab", "  ab  c ", "aé b😀c", "abcabcab" * 30, "x", "c\na"]:
        ids = tok.encode(t, add_special_tokens=False).ids
        assert ids == sp.encode(t), t
        if 0 not in ids:
            assert restored(parse_model(raw), tok.decode(ids, skip_special_tokens=False)) == sp.decode(ids), t


@pytest.mark.parametrize("byte_fallback", [True, False])
@pytest.mark.parametrize("squeeze", [True, False])
@pytest.mark.parametrize("prefix", [True, False])
def test_segments_give_whole_texts(byte_fallback, squeeze, prefix):
    raw = small_model(byte_fallback, squeeze, prefix)
    spec = parse_model(raw)
    sp, tok = sentencepiece.SentencePieceProcessor(model_proto=raw), rebuild(spec)
    assert splits(spec)
    texts = ["abc", "a bc  abc ab", None, "", "  ab  c ", "aé b😀c ", "abcabcab" * 30, "x", "c\na", " ", "   ", "a▁b ▁ c"]
    expected = [sp.encode(t or "") for t in texts]
    for most, most_bytes in ((1 << 18, 1 << 20), (3, 1 << 20), (0, 64), (100, 2)):
        segments = Segments(spec, tok, most, most_bytes)
        for _ in range(2):
            ids, sizes, back = segments.encode(texts)
            assert as_lists(ids, sizes) == expected
            assert back.tolist() == [0 not in i for i in expected]
            assert len(segments.known) <= most and segments.bytes <= most_bytes


def as_lists(ids, sizes):
    return [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]


def test_pieces_across_markers_are_no_segments():
    m = pb.ModelProto()
    m.ParseFromString(small_model(True, False, True))
    m.pieces.add(piece="b▁a", score=-1, type=1)
    raw = m.SerializeToString()
    spec = parse_model(raw)
    assert not splits(spec)
    sp, tok = sentencepiece.SentencePieceProcessor(model_proto=raw), rebuild(spec)
    for t in ("ab ab a", "b a b a"):
        assert tok.encode(t, add_special_tokens=False).ids == sp.encode(t)


def test_segments_on_whole_documents(spark):
    """The distinct segments give the original library's ids, text for text."""
    with open(tokenizer_path("piece_bpe_32k.model"), "rb") as f:
        raw = f.read()
    spec = parse_model(raw)
    assert splits(spec)
    sp, tok = sentencepiece.SentencePieceProcessor(model_proto=raw), rebuild(spec)
    texts = [r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()] + ODD
    segments = Segments(spec, tok)
    ids, sizes, back = segments.encode(texts)
    assert as_lists(ids, sizes) == [sp.encode(t) for t in texts] and all(back)
    assert as_lists(ids, sizes) == [e.ids for e in tok.encode_batch_fast(texts, add_special_tokens=False)]
