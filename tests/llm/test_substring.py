import random

from boxframe.llm import substring


def brute(rows, window):
    least = {}
    for i, text in rows:
        words = (text or "").encode().split()
        for k in range(len(words) - window + 1):
            w = tuple(words[k : k + window])
            least[w] = min(least.get(w, i), i)
    out = {}
    for place, (i, text) in enumerate(rows):
        words = (text or "").encode().split()
        gone = set()
        for k in range(len(words) - window + 1):
            if least[tuple(words[k : k + window])] < i:
                gone.update(range(k, k + window))
        out[place] = (len(words), len(gone), b" ".join(w for k, w in enumerate(words) if k not in gone).decode())
    return out


def check(spark, rows, window, seed):
    docs = spark.createDataFrame([(i, t, p) for p, (i, t) in enumerate(rows)], "doc_id long, text string, place int")
    got = substring.dedup_substrings(docs, window=window, seed=seed).select("row.place", "kept_text", "n_words", "n_removed", "spans").collect()
    wanted = brute([(2**63 if i is None else i, t) for i, t in rows], window)
    assert {r.place: (r.n_words, r.n_removed, " ".join(w.decode() for w in (r.kept_text or "").encode().split())) for r in got} == wanted
    assert all(sum(s.end - s.first for s in r.spans) == r.n_removed for r in got)


def test_equals_brute_force(spark):
    rng = random.Random(2)
    passages = [[f"p{rng.randint(0, 30)}" for _ in range(rng.randint(4, 40))] for _ in range(8)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randint(0, 5)):
            words += rng.choice(passages)[rng.randint(0, 4) :] if rng.random() < 0.6 else [rng.choice("abcdef") for _ in range(rng.randint(1, 12))]
        rows.append((rng.choice([i, i, i, i // 2]), rng.choice([" ", "\n", "  "]).join(words)))
    check(spark, rows, 8, 3)
    check(spark, rows, 5, 5)


def test_odd_rows(spark):
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    same = " ".join(f"s{i}" for i in range(60))
    repeated = "a " * 200
    rows = [(5, None), (6, ""), (7, " \t\n "), (1, long), (2, "x " + long), (None, same), (9, same), (9, same), (3, repeated), (4, repeated), (8, same[:40])]
    check(spark, rows, 50, 10)


def test_white_space_and_clashing_columns(spark):
    passage = " ".join(f"p{i}" for i in range(50))
    docs = spark.createDataFrame([(1, passage, 3), (2, f"a\n\nb\t{passage}\nc  d", 4)], "doc_id long, text string, n_words int")
    got = {r.row.doc_id: r for r in substring.dedup_substrings(docs).collect()}
    assert got[2].kept_text == "a\n\nb\tc  d" and got[2].row.n_words == 4 and got[2].n_words == 54
    assert substring.dedup_substrings(docs.limit(0)).count() == 0
