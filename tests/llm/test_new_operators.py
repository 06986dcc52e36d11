"""Phrases, the conversation trie and quality rules: each against brute force, and on awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from patentlake.llm import phrases, quality_rules, trie

# --- phrases --------------------------------------------------------------------------


def brute_phrases(rows, least, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in (1, 2, 3, 4) for i in range(len(w) - k + 1))
    long = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    out = defaultdict(list)
    for (lang, w), a in long.items():
        score, _, left, right = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        around = (b for (la, v), b in long.items() if la == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1)))
        if not any(100 * b >= 80 * a for b in around):
            out[lang].append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, k, p.decode(), -a, le, ri, n[lang], -s) for lang, xs in out.items() for k, (s, a, p, le, ri) in enumerate(sorted(xs)[:top], 1))


def some_texts(seed, docs=60):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "new", "york", "city", "état", "x1", "B", "日本", "a'b", "-"]
    fixed = ["new york city hall opens", "in the state of new york", "la la la la la", "one two three four five six seven eight nine ten"]
    rows = []
    for _ in range(docs):
        parts = [rng.choice(fixed) if rng.random() < 0.4 else " ".join(rng.choices(vocabulary, k=rng.randint(0, 6))) for _ in range(12)]
        rows.append((rng.choice(["en", "fr", None]), "".join(p + rng.choice([" ", ". ", "\n", "\t", "!?", "\x0b", ""]) for p in parts)))
    return rows


@pytest.mark.parametrize(("most_words", "rounds", "seed"), [(1 << 20, 6, 1), (3, 2, 2), (0, 0, 3)])
def test_phrases(spark, monkeypatch, most_words, rounds, seed):
    """With all frequent words in the table, with some and with none; paths compacted or not."""
    monkeypatch.setattr(phrases, "HOT_PART", 8)
    rows = [*some_texts(seed), ("en", None), ("fr", ""), (None, " . , "), ("en", "x" * 3000), *[("en", "same words here again")] * 40]
    docs = spark.createDataFrame([(la, t, "w", 1) for la, t in rows], "lang string, text string, a string, n long")
    got = sorted(map(tuple, phrases.collocations(docs, least=10, top=25, most_words=most_words, rounds=rounds).collect()))
    assert got == brute_phrases(rows, 10, 25)
    assert got


def test_phrases_of_edge_rows(spark, edge, nothing):
    assert sorted(map(tuple, phrases.collocations(edge, least=30).collect())) == brute_phrases([(r.lang, r.text) for r in edge.collect()], 30, 2000)
    assert phrases.collocations(nothing).collect() == []


def test_paths_are_compacted(spark):
    """A chain of ten words is two paths that meet at the fork, where a third one begins."""
    grams = phrases.gram_counts(spark.createDataFrame([(i, i + 1, i + 2, i + 3, 40) if i < 8 else (i, i + 1, i + 2 if i < 9 else 0, 0, 40) for i in range(1, 10)] + [(5, 6, 7, 99, 31), (6, 7, 99, 0, 31), (7, 99, 0, 0, 31)], "a long, b long, c long, d long, n long"), 30, 0)
    nodes = grams.where("c <> 0 AND d = 0").select("a", "b", "c", "n")
    paths = phrases.compacted(grams.where("d <> 0"), nodes, 20).collect()
    assert sorted(tuple(p.ids) for p in paths) == [(1, 2, 3, 4, 5, 6, 7), (5, 6, 7, 8, 9, 10), (5, 6, 7, 99)]
    assert Counter((i, p.n) for p in paths for i in zip(*(p.ids[k:] for k in range(4)), strict=False)) == Counter({((i, i + 1, i + 2, i + 3), 40): 1 for i in range(1, 8)} | {((5, 6, 7, 99), 31): 1})


def test_exact_scores(spark):
    row = spark.range(1).selectExpr("9000000000000000000L AS a", "9100000000000000000L AS l", "9200000000000000000L AS r")
    assert row.select(phrases._score(row.a, row.l, row.r)).collect()[0][0] == 2000000 * 9000000000000000000 // 18300000000000000000


# --- trie -----------------------------------------------------------------------------


def brute_trie(rows):
    turns = defaultdict(list)
    for c, n, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append((n is not None, n or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest(), role, text))
    turns = {c: [x[3:] for x in sorted(ts)] for c, ts in turns.items()}
    whole = {}
    for c, ts in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(turns.get(c - c % 20, [])[:h] + ts[h:])
    members = defaultdict(list)
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, cs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(cs) - 1) * len(re.findall("[^ \t-\r]+", p[-1][1])) if p else 0
    ends = lambda p: ",".join(str(c) for c in sorted(members[p]) if whole[c] == p)
    return Counter((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), children[p], leaves[p], saved[p], hashlib.sha256(ends(p).encode()).hexdigest()) for p, cs in members.items())


def some_turns(seed, conversations, words):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        rows += [(c, k if rng.random() < 0.9 else None, rng.choice(["user", "assistant", None]), rng.choice(words)) for k in range(rng.randint(1, 9))]
    rows += [(1000 + c, k, "user", "the same turn") for c in range(30) for k in range(5)]  # copies
    rows += [(2000 + c, k, "user", "longer and longer") for c in range(12) for k in range(c)]  # paths within paths
    rows += [(5000, k, "user", f"turn {k % 7}") for k in range(600)]
    return rows


@pytest.mark.parametrize(("most", "turns", "parts"), [(4096, 1 << 18, 4), (5, 1 << 18, 3), (1, 1, 7), (64, 20, 1)])
def test_trie(spark, most, turns, parts):
    rows = [*some_turns(most, 60, ["hi there", "ok", None, "", "a b\tc\nd"]), (None, 1, "user", "nobody's"), (7, None, None, None), (7, None, None, None)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, key string")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = Counter(map(tuple, trie.prefix_trie(table, most=most, size=turns).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == brute_trie(rows)


def test_trie_of_nothing(spark):
    assert trie.prefix_trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


def test_shard_bitmaps():
    shard = trie.Shard([(4, [b"a"], [1]), (9, [b"a", b"b"], [1, 2]), (2, [b"a", b"c"], [1, 5])])
    assert shard.postings[0] == {b"a": 0b111} and shard.postings[1] == {b"b": 0b010, b"c": 0b100} and shard.ends == {1: 0b001, 2: 0b110}
    root = list(shard.nodes())[-1]
    assert (root["n_convs"], root["n_leaves"], root["saved_tokens"], root["n_children"], root["conv_id"]) == (3, 2, 2, 1, 2)


# --- quality rules --------------------------------------------------------------------

WORD = re.compile("[^ \t-\r]+")


def brute_signals(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    hit = {j for i in range(len(w) - 2) if windows[w[i], w[i + 1], w[i + 2]] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit), len(lines)


def brute_rules(rows, least):
    signals = [brute_signals(t) for _, t, _, _ in rows]
    rates = [None if not s[0] else {"symbols": s[2] * 10**6 // s[0], "repeats": s[4] * 10**6 // s[0], "lines": s[3] * 10**6 // s[5], "length": s[1] * 10**6 // s[0]} for s in signals]
    out = []
    for (i, _, la, so), s, r in zip(rows, signals, rates, strict=True):
        outside = 0
        for name, _, _, slack, both in quality_rules.SIGNALS if r else ():
            for group in ((la, so), (la,), ()):
                values = sorted(x[name] >> max(x[name].bit_length() - 6, 0) << max(x[name].bit_length() - 6, 0) for x, (_, _, *g) in zip(rates, rows, strict=True) if x and tuple(g[: len(group)]) == group)
                if len(values) >= least or not group:
                    break
            q1, q2, q3 = (values[-(-len(values) * k // 4) - 1] for k in (1, 2, 3))
            outside += r[name] > q2 + 4 * (q3 - q2) + slack or (both and r[name] < q2 - 4 * (q2 - q1) - slack)
        failed = s[0] < 50 or 100 * s[4] > 50 * s[0]
        out.append((i, *s, failed, outside, not failed and outside == 0))
    return Counter(out)


def test_quality_rules(spark, edge, nothing):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefé", k=rng.randint(1, 9)))
    rows = [(r.doc_id, r.text, r.lang, "s") for r in edge.collect()]
    for i in range(300):
        lines = [" ".join(word() + rng.choice(["", "", "", "$", "**"] if i % 9 == 0 else [""]) for _ in range(rng.randint(1, 14))) for _ in range(12)]
        lines += [lines[0]] * (8 if i % 11 == 0 else 0)
        rows.append((100 + i, "\n".join(lines), ["en", "de", None][i % 3], ["a", "a", None, "b"][i % 4]))
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, source string, kept string")
    for least in (1, 40, 10**6):
        got = quality_rules.apply_rules(docs, least=least).select("doc_id", *quality_rules.COUNTS, "base_failed", "n_outside", "kept")
        assert Counter(map(tuple, got.collect())) == brute_rules(rows, least)
    assert quality_rules.apply_rules(nothing.withColumn("source", nothing.lang)).collect() == []


def test_sketches_merge(spark):
    """Sketches of sources add up to that of their language, and quartiles are at most 1/32 too low."""
    rng = random.Random(1)
    rows = [("en", rng.choice("xyz"), rng.randint(1, 500), rng.randint(0, 3000)) for _ in range(2000)]
    counts = spark.createDataFrame([(la, so, n, w, 0, 0, 0, 1) for la, so, n, w in rows], "lang string, source string, " + ", ".join(f"{c} long" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")))
    fine = quality_rules.sketches(counts, ["lang", "source"])
    whole = quality_rules.sketches(counts, ["lang"])
    assert sorted(map(tuple, quality_rules.merged(fine, ["lang"]).collect())) == sorted(map(tuple, whole.collect()))
    got = quality_rules.quartiles(whole, ["lang"]).where("signal = 'length'").collect()[0]
    values = sorted(w * 10**6 // n for _, _, n, w in rows)
    for k in (1, 2, 3):
        exact = values[-(-len(values) * k // 4) - 1]
        assert exact - exact // 32 - 1 <= got[f"q{k}"] <= exact
