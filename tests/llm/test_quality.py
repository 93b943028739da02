import random

from boxframe.llm import quality

SHAPE = "doc_id long, text string, lang string, source string, base string, row int"


def words_of(text):
    return (text or "").encode().split()


def brute(text):
    words = words_of(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    return (
        len(words),
        sum(len(w.decode()) for w in words),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_counts_equal_brute_force(spark):
    rng = random.Random(1)
    texts = [None, "", " \n\t ", "é ü\x0bx\x0c\r", "a b c d e f g h a b c d e f g h", "x\nx\n\n \ny#|<>&", "w " * 30_000]
    texts += [" ".join(rng.choice(["a", "b", "c\n", "dd", "e*"]) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, "en", None, "other", 7) for i, t in enumerate(texts)], SHAPE)
    got = {
        r.doc_id: tuple(r.base[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        for r in quality.quality_rules(docs).select("row.doc_id", "base").collect()
    }
    long = texts.index("w " * 30_000)
    assert got.pop(long) == (30_000, 30_000, 0, 0, 30_000)
    assert got == {i: brute(t) for i, t in enumerate(texts) if i != long}


def test_fences_follow_their_group(spark):
    plain = [f"word{i} " * 1 + " ".join(f"w{i}x{j}" for j in range(30)) for i in range(300)]
    marked = [" ".join(f"w{i}x{j}#" for j in range(30)) for i in range(300)]
    rows = [(i, t, "en", "plain", "b", 1) for i, t in enumerate(plain)]
    rows += [(1000 + i, t, "en", "marked", "b", 1) for i, t in enumerate(marked)]
    # A symbol on every word is odd in one source and usual in the other.
    rows += [(5000, marked[0], "en", "plain", "b", 1), (5001, None, None, None, None, None), (5001, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, SHAPE)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert 5000 not in ids and 5001 not in ids and len(ids) == 600


def test_moderate_junk_in_a_clean_group(spark):
    def text(i, word="w{i}x{j}"):
        return " ".join(word.format(i=i, j=j) for j in range(30))

    rows = [(i, text(i), "en", "clean", "b", 1) for i in range(200)]
    # A table that lost its lines, words cut into letters, and words run together; one symbol in 30 words is no junk.
    rows += [(900, " | ".join(f"w9x{j}" for j in range(30)), "en", "clean", "b", 1), (901, text(1, "{j}"), "en", "clean", "b", 1)]
    rows += [(902, text(2, "w{i}x{j}runtogether"), "en", "clean", "b", 1), (903, text(3) + "#", "en", "clean", "b", 1)]
    ids = {r.doc_id for r in quality.keep_good(spark.createDataFrame(rows, SHAPE)).collect()}
    assert ids == {*range(200), 903}


def test_small_groups_use_wider_sketches(spark):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(30)), "en", f"s{i % 50}", "b", 1) for i in range(200)]
    rows += [(999, " ".join(f"w{j}###" for j in range(30)), "fr", "s999", "b", 1)]
    ids = {r.doc_id for r in quality.keep_good(spark.createDataFrame(rows, SHAPE)).collect()}
    assert ids == set(range(200))


def test_empty_table(spark):
    assert quality.keep_good(spark.createDataFrame([], SHAPE)).count() == 0
