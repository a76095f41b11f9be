"""Quality rules, phrase collocations and the prefix trie against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from conftest_llm import edge_rows

from tradewind.llm import phrases, rules, trie

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORDS.findall(text)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    runs = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(runs)
    inside = {i + k for i, r in enumerate(runs) if times[r] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside))


def plain_cells(text, buckets):
    hashes = [zlib.crc32(w.encode()) for w in WORDS.findall(text or "")]
    return [h % buckets for h in hashes] + [(g * 31 + h * 7919 + 12345) % buckets for g, h in zip(hashes, hashes[1:])]


def plain_scores(rows, trusted, buckets, prior=1.0):
    every, sure = Counter(), Counter()
    for i, text in rows:
        every.update(c := plain_cells(text, buckets))
        if i in trusted:
            sure.update(c)
    n, t, mass = sum(every.values()), sum(sure.values()), prior * buckets
    weight = {c: round(1e6 * (math.log(sure[c] * (n + buckets) / (every[c] + 1) + mass) - math.log(t + mass))) for c in every}
    return [(len(c := plain_cells(text, buckets)), sum(weight[x] for x in c)) for _, text in rows]


def test_rules_edges(edges, nothing, spark):
    rows = [(r[0], r[1]) for r in edge_rows()]
    sure = spark.createDataFrame([(1,), (4,), (4,), (None,), (999,)], "doc_id long")
    got = rules.judge(edges, rules.gram_weights(edges, sure, buckets=64), buckets=64)
    want = []
    for (i, text), (grams, score) in zip(rows, plain_scores(rows, {1, 4}, 64)):
        n = plain_counts(text)
        failed = n[0] < 50 or 100 * n[4] > 50 * n[0]
        want.append((i, *n, failed, not failed and score >= -100_000 * grams, grams, score))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert rules.judge(nothing, rules.gram_weights(nothing, sure)).count() == 0
    assert rules.judge(edges, rules.gram_weights(edges, sure.limit(0))).agg({"score": "sum"}).first()[0] == 0
    assert rules.judge(edges, rules.gram_weights(nothing, sure)).count() == len(rows)


def test_rules_reject_odd_texts(spark):
    good = [(i, " ".join(f"word{(i * 7 + k * k) % 90}" for k in range(120))) for i in range(60)]
    odd = [(100 + i, " ".join(f"{k % 11}$$${(i + k) % 50}" for k in range(120))) for i in range(10)]
    docs = spark.createDataFrame(good + odd, "doc_id long, text string")
    sure = docs.where("doc_id < 30").select("doc_id")
    kept = {r.doc_id for r in rules.judge(docs, rules.gram_weights(docs, sure)).where("kept").collect()}
    assert kept == {i for i, _ in good}


def plain_phrases(rows, least, percent, top):
    grams, size = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            size[lang] += len(words)
            for k in (1, 2, 3):
                grams[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in grams.items():
        picked = []
        for g, a in f.items():
            if len(g) < 2 or a < least:
                continue
            longer = [x for h, x in f.items() if len(g) == 2 and len(h) == 3 and x >= least and g in (h[:2], h[1:])]
            if any(100 * x >= percent * a for x in longer):
                continue
            cuts = [(10 ** 6 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            picked.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for i, (s, a, p, left, right) in enumerate(sorted(picked)[:top]):
            out.append((lang, i + 1, p.decode(), -a, left, right, size[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("share, bucket_words", [(1 / 8192, 1 << 19), (1 / 50, 40), (1 / 3, 7)])
def test_phrases(edges, nothing, spark, share, bucket_words, monkeypatch):
    monkeypatch.setattr(phrases, "_FLUSH", 300)
    monkeypatch.setattr(phrases, "_MERGE", 50)
    rows = [(r[2], r[1]) for r in edge_rows()] + [(lang, "Of the Sea; of the sea of the\nland. A a a a à la à la") for lang in ("fr", None, "")] * 6
    rows += [(None, None), ("en", "y" * 300_000 + " of the sea")] * 3
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "lang string, text string, w1 string, f int, bucket int").repartition(5)
    real = phrases.gram_counts
    monkeypatch.setattr(phrases, "gram_counts", lambda *a: real(*a, bucket_words=bucket_words, share=share))
    for least, top in ((2, 2000), (10, 4)):
        got = phrases.collocations(docs, least=least, top=top)
        assert sorted(map(tuple, got.collect())) == plain_phrases(rows, least, 50, top)
    assert phrases.collocations(nothing).count() == 0


def plain_trie(rows, span=100, modulus=6):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tid = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            own[conv].append((turn is not None, turn or 0, tid, role, text))
    turns = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in turns.items():
        h = zlib.crc32(str(c).encode()) % modulus
        built[c] = tuple(turns.get(c - math.fmod(c, span), [])[:h] + v[h:])
    return plain_nodes(built)


def plain_nodes(built):
    members = defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    kids = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1]) if k else 0
    return sorted(((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k], hashlib.sha256(
        ",".join(map(str, sorted(c for c in m if built[c] == k))).encode()).hexdigest()) for k, m in members.items()), key=str)


def conversations():
    rows = [(c, t, "user" if t % 2 else "assistant", f"turn {t} {'x' * (t % 4)}" if t < 5 else f"own {c % 7} {t}") for c in range(90, 230, 3) for t in range(9)]
    rows += [(c, t, "user", f"same {t}") for c in (100, 200, 300, 301, 302, 303) for t in range(40, 60)]
    rows += [(5, None, None, None), (5, 1, "user", ""), (5, 1, "user", ""), (5, 1, "tool", "ü"), (None, 1, "user", "nobody"), (7, 0, "user", "short"), (8, 0, "", "")]
    rows += [(c, None, "user", "z" * 400_000) for c in (11, 12, 12)]
    rows += [(1000 + c, t, "user", f"{t if t < 30 or c % 4 else (c, t)}") for c in range(12) for t in range(30 + c)]
    return rows


@pytest.mark.parametrize("limit, slab", [(1 << 16, 1024), (20, 1024), (1, 7), (40, 5), (1 << 16, 3)])
def test_trie(spark, limit, slab):
    rows = conversations()
    turns = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, conv long, top string").repartition(4)
    got = trie.prefix_trie(*trie.share_openings(trie.turn_rows(turns)), limit=limit, slab=slab)
    assert sorted(map(tuple, got.collect()), key=str) == plain_trie(rows)


def test_trie_empty(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert trie.prefix_trie(*trie.share_openings(trie.turn_rows(none))).count() == 0
    alone = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    assert sorted(map(tuple, trie.prefix_trie(*trie.share_openings(trie.turn_rows(alone))).collect()), key=str) == plain_trie([(1, 0, "user", "x")])
