import numpy as np

from corpusloom.llm import sentencepiece_codec as S

TEXTS = ["a few plain words", "  two  blanks ", "▁own mark", "x" * 200 + " long", "日本 né \U0001f600\x00 tab\tline\nend", "", " ", "few words again"] + [f"no {i} q{i * 7919:x}z" for i in range(400)]


def counted(codec, seen):
    class Reference:
        def __getattr__(self, name):
            return getattr(inner, name)

        def encode(self, texts, **options):
            seen.append(len(texts))
            return inner.encode(texts, **options)

    inner, codec.reference = codec.reference, Reference()


def test_joined_segments_are_the_libraries_own():
    with open(S.MODEL, "rb") as f:
        codec = S.Codec(f.read())
    plain, seen = codec.reference, []
    counted(codec, seen)
    for text, (ids, same, back) in zip(TEXTS, codec.round_trips(TEXTS), strict=True):
        assert same and ids.tolist() == plain.encode(text) and (back == text or "▁" in text)
    assert sum(seen) < 100  # over 800 segments
    assert not any(len(s) > S.KEPT_CHARS for s in codec.young)


def test_a_segment_on_which_the_libraries_differ(monkeypatch):
    with open(S.MODEL, "rb") as f:
        codec = S.Codec(f.read())
    inner = codec.reference

    class Reference:
        def __getattr__(self, name):
            return getattr(inner, name)

        def encode(self, texts, **options):
            return [[0, *ids] if "plain" in t else ids for t, ids in zip(texts, inner.encode(texts, **options), strict=True)]

    codec.reference = Reference()
    got = codec.encode(TEXTS)
    assert [same for _, same in got] == ["plain" not in t for t in TEXTS]
    assert all(np.array_equal(ids, inner.encode(t)) for t, (ids, _) in zip(TEXTS, got, strict=True))
    assert codec.differ == {"▁plain"}
