import random
import struct

import numpy as np
import public_tokenizers
import pytest

from boxframe.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Pieces.load(PATH)


def ids_of(vocabulary, text):
    return np.frombuffer(vocabulary.encode([text])[0], np.int32)


def score(vocabulary, ids):
    by_id = dict(zip(vocabulary.plain.tolist(), vocabulary.scores.tolist(), strict=True))
    return sum(by_id.get(i, 0.0) for i in ids)


def brute(vocabulary, names, word):
    """Best score of a word by plain dynamic programming; unknown characters have the penalty."""
    best = [0.0] + [-1e18] * len(word)
    for e in range(1, len(word) + 1):
        for s in range(max(0, e - 48), e):
            if word[s:e] in names:
                best[e] = max(best[e], best[s] + names[word[s:e]])
        if word[e - 1] not in names:
            best[e] = max(best[e], best[e - 1] + vocabulary.worst)
    return best[-1]


def test_best_score_equals_brute_force(vocabulary):
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=PATH)
    names = {model.id_to_piece(int(i)): float(s) for i, s in zip(vocabulary.plain, vocabulary.scores, strict=True)}
    rng = random.Random(1)
    words = ["the", "internationalisation", "ünïcödé", "日本語", "x" * 60, "😀a", "ba\nna"]
    words += ["".join(rng.choice("abcdeéñß ") for _ in range(rng.randint(1, 20))).replace(" ", "") or "a" for _ in range(300)]
    unknown = set(vocabulary.byte_ids.tolist())
    for word in words:
        ids = ids_of(vocabulary, word).tolist()
        missing = sum(c not in names for c in word)
        found = score(vocabulary, [i for i in ids if i not in unknown]) + missing * vocabulary.worst
        assert found == pytest.approx(brute(vocabulary, names, pieces.MARK + word), abs=1e-3), word


def test_long_words_as_short_ones(vocabulary):
    rng = random.Random(4)
    for letters in ("etaoin shrdlu", "日本語中文字", "aé😀\n"):
        word = pieces.MARK + "".join(rng.choice(letters.replace(" ", "")) for _ in range(40))
        raw = word.encode()
        ids, _ = vocabulary.segment(np.frombuffer(raw, np.uint8).reshape(1, -1))
        assert vocabulary.segment_long(raw).tolist() == ids.tolist()


def test_a_megabyte_without_a_space(vocabulary):
    import time

    rng = random.Random(5)
    for letters in ("etaoinshrdlucmfw", "日本語中文字漢新聞"):
        text = "".join(rng.choices(letters, k=1_000_000 // len(letters[0].encode())))
        began = time.process_time()
        ids = ids_of(vocabulary, text)
        assert time.process_time() - began < 30
        assert vocabulary.decode(ids) == text
    assert not any(len(w) > pieces.GROUPED for w in vocabulary.memo)


def test_words_stay_known_over_a_generation(vocabulary, monkeypatch):
    monkeypatch.setattr(pieces, "MEMO", 3)
    texts = ["one two three four five", "one six seven eight nine", "one two ten"]
    assert [ids_of(vocabulary, t).tolist() for t in texts * 2] == [ids_of(pieces.Pieces.load(PATH), t).tolist() for t in texts] * 2


def fields(raw):
    """Fields of a protocol buffer: number, wire type, bytes."""

    def number(i):
        value = shift = 0
        while True:
            value |= (raw[i] & 127) << shift
            shift, i = shift + 7, i + 1
            if raw[i - 1] < 128:
                return value, i

    i = 0
    while i < len(raw):
        key, i = number(i)
        if key & 7 == 0:
            _, end = number(i)
        elif key & 7 == 5:
            end = i + 4
        else:
            size, i = number(i)
            end = i + size
        yield key >> 3, key & 7, raw[i:end]
        i = end


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def packed(number, kind, raw):
    return varint(number << 3 | kind) + (varint(len(raw)) if kind == 2 else b"") + raw


def test_library_finds_no_better_path(vocabulary):
    """The same pieces and scores as a unigram model of the library: equal scores, rarely another path."""
    from sentencepiece import SentencePieceProcessor

    by_id = dict(zip(vocabulary.plain.tolist(), vocabulary.scores.tolist(), strict=True))
    raw, made, place = open(PATH, "rb").read(), b"", 0
    for number, kind, value in fields(raw):
        if number == 1:
            value = b"".join(packed(n, k, struct.pack("<f", by_id.get(place, struct.unpack("<f", v)[0])) if n == 2 else v) for n, k, v in fields(value))
            place += 1
        elif number == 2:
            value = b"".join(packed(n, k, varint(1) if n == 3 else v) for n, k, v in fields(value))
        made += packed(number, kind, value)
    library = SentencePieceProcessor(model_proto=made)
    rng = random.Random(2)
    syllables = ["th", "er", "on", "an", "re", "ción", "eau", "ß", "über", "!", "12", "\n"]
    texts = [" ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 5))) for _ in range(80)) for _ in range(100)]
    same = 0
    for text in [*texts, " two  spaces ", "日本 😀"]:
        mine, theirs = ids_of(vocabulary, text).tolist(), library.encode(text)
        assert score(vocabulary, mine) == pytest.approx(score(vocabulary, theirs), abs=1e-2)
        same += mine == theirs
    assert same >= 90


def test_trie_holds_its_words():
    words = {w.encode(): i for i, w in enumerate(["a", "ab", "abc", "b", "é", "zebra", "zeb"])}
    trie = pieces.Trie.of(words)
    for word, i in words.items():
        node = 0
        for c in word:
            to = trie.base[node] + c + 1
            assert trie.check[to] == node
            node = to
        assert trie.piece[node] == i


def test_round_trip(spark):
    rows = [(1, None, 5), (2, "", 5), (3, "  two  spaces ", 5), (4, "日本 😀x\n\ty", 5), (5, "w" * 5000, 5), (6, "some word " * 20_000, 5), (7, "same", 5), (7, "same", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, target int")
    out = pieces.decode_pieces(pieces.encode_pieces(docs, PATH), PATH)
    assert out.columns == ["doc_id", "text", "target", "piece_ids", "decoded"]
    assert all(r.decoded == (r.text or "") and r.target == 5 for r in out.collect())
    assert pieces.encode_pieces(docs.limit(0), PATH).count() == 0
    assert pieces.encode_pieces(docs.withColumnRenamed("target", "piece_ids"), PATH).columns == ["doc_id", "text", "piece_ids"]
