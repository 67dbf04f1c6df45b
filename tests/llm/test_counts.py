"""Token counts and SentencePiece against the libraries."""

import hashlib

import pytest

P = pytest.importorskip("public_tokenizers")


def test_token_counts_equal_the_library(documents, texts, nothing):
    from tokenizers import Tokenizer

    from milepost.llm.token_count import token_counts

    path = P.path("byte_bpe_50k.json")
    known = Tokenizer.from_file(path)
    expected = {i: (len((t or "").encode()), n := len(known.encode(t or "", add_special_tokens=False).ids), n > 512) for i, t in enumerate(texts)}
    got = token_counts(documents, path).collect()
    assert len(got) == len(texts) + 2
    assert {r[0]: tuple(r)[1:] for r in got} == expected
    assert token_counts(nothing, path).count() == 0


def test_long_pretokens_merge_alike():
    from tokenizers import Tokenizer

    from milepost.llm.token_count import Merges, counter

    path = P.path("byte_bpe_50k.json")
    known, count = Tokenizer.from_file(path), counter(Merges(path))
    hard = ["a" * n for n in range(1, 40)] + ["abab" * 50 + "b", "ththe" * 77, "é" * 99, "  \n \n  x", "don't we'll", "　　a"]
    assert count(hard) == [len(known.encode(t).ids) for t in hard]


def test_piece_ids_equal_the_library(documents, texts, nothing):
    import sentencepiece

    from milepost.llm import pieces

    path = P.path("piece_bpe_32k.model")
    known = sentencepiece.SentencePieceProcessor(model_file=path)
    both = pieces.decode(pieces.encode(documents, path), path)
    rows = both.collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        ids = known.encode(r["text"] or "")
        assert r["piece_ids"] == ids
        assert r["decoded"] == known.decode(ids) == (r["text"] or "").replace("▁", " ")
    at_once = pieces.encode(documents, path, decoded_col="decoded")
    assert sorted(map(repr, at_once.collect())) == sorted(map(repr, rows))
    for r in pieces.digest(both).collect():
        ids = known.encode(texts[r["doc_id"]] or "")
        assert (r["n_pieces"], r["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
    assert pieces.decode(pieces.encode(nothing, path), path).count() == 0


def test_unigram_model_takes_the_best_sum(tmp_path):
    """A handmade model, as no public one is at hand: the same core without the merge rule."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    from milepost.llm.pieces import Encoder, Pieces

    model = pb.ModelProto()
    kinds = pb.ModelProto.SentencePiece
    for piece, score, kind in [("<unk>", 0, kinds.UNKNOWN), ("▁", -3, 1), ("a", -2, 1), ("b", -2.5, 1), ("c", -3.1, 1), ("ab", -3.7, 1), ("bc", -4.2, 1), ("▁a", -4.1, 1), ("abc", -7.3, 1)]:
        model.pieces.add(piece=piece, score=score, type=kind)
    model.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.remove_extra_whitespaces = False
    path = tmp_path / "own.model"
    path.write_bytes(model.SerializeToString())
    known = sentencepiece.SentencePieceProcessor(model_file=str(path))
    encoder = Encoder(Pieces(str(path)))
    import numpy as np

    for text in ["abc", "a b c abcabc", "bca", "zab zz", "  ab"]:
        assert np.frombuffer(encoder.encode([text])[0], "<i4").tolist() == known.encode(text), text
