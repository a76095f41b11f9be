"""Language model, tokenizers, fingerprints, classifier, near-dedup and pipeline against plain versions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from conftest_llm import SF, TEXTS, edge_rows
from tokenizers import Tokenizer

import corpus_pipeline
from tradewind.llm import components, fingerprints, masked_lm, mixing, near_dedup, pieces, quality, queries, token_files

MODEL, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")


def documents():
    return duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


def test_pieces_query(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = {r.doc_id: r for r in queries.QUERIES["op4_sentencepiece"](spark, SF).collect()}
    for doc_id, text in documents():
        ids, r = model.encode(text), got.pop(doc_id)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()
    assert not got


def test_piece_spans(edges, nothing):
    for r in pieces.encode_pieces(edges.where("text IS NOT NULL"), MODEL).join(edges.select("doc_id", "text").distinct(), "doc_id").collect():
        at = 0
        for start, end in zip(r.starts, r.ends):       # the spans follow each other and cover the text
            assert start == at
            at = end
        assert at == len(r.text.encode()) and r.decoded == r.text
    rows = pieces.encode_pieces(edges, MODEL).collect()
    assert len(rows) == len(edge_rows())
    assert all(r.ids == [] for r in rows if r.doc_id == 7)             # the null text
    assert pieces.encode_pieces(nothing, MODEL).count() == 0


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
def test_character_map(rule):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    own = pieces.Normaliser(library.serialized_model_proto())
    for text in [t for t in TEXTS if t and len(t) < 500] + ["ﬁne ①② ｶﾞ Å ℃ ＡＢＣ", "é  x"]:
        whole, starts, ends = own(text.encode())
        assert whole.decode() == library.normalize(text)
        assert all(0 <= a <= b <= len(text.encode()) for a, b in zip(starts, ends))
        assert list(starts) == sorted(starts)


def test_token_query(spark):
    tokenizer = Tokenizer.from_file(BYTES)
    got, before = {r.doc_id: r for r in queries.QUERIES["op9_token_files"](spark, SF).collect()}, 0
    for doc_id, text in documents():
        ids, r = [*tokenizer.encode(text, add_special_tokens=False).ids, 2], got.pop(doc_id)
        assert (r.start, r.n_tokens, r.ids_crc32) == (before, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        before += len(ids)
    assert not got


def test_tokens_of_odd_texts():
    tokenizer, made = Tokenizer.from_file(BYTES), random.Random(3)
    odd = ["a", "b", " ", "  ", "\n", "\t", "'s", "1", ".", "é", " ", "　", "\x85", "\x0b", "\x1c", "\u2028", "<|endoftext|>", "漢", " \n ", "x" * 70]
    texts = ["".join(made.choice(odd) for _ in range(made.randint(0, 14))) for _ in range(4000)]
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert sum(50256 in w for w in want) > 500
    column = pa.array(texts, pa.large_string())
    assert token_files.encode_batch(column, BYTES).to_pylist() == want
    assert token_files.encode_batch(column, BYTES, 2).to_pylist() == [[*w, 2] for w in want]
    assert token_files.encode_batch(column[7:90], BYTES).to_pylist() == want[7:90]
    assert token_files.encode_batch(column[:0], BYTES, 2).to_pylist() == []


def test_token_files(spark, edges, nothing, tmp_path):
    folder = str(tmp_path / "tokens")
    token_files.write_tokens(edges, folder, BYTES, 2)
    rows = token_files.read_tokens(spark, folder)
    assert rows.count() == len(edge_rows()) and rows.where("doc_id = 4").count() == 1
    table = token_files.token_table(edges, BYTES, 2).collect()
    ends = sorted((r.start, r.start + r.n_tokens) for r in table)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    assert token_files.token_table(nothing, BYTES, 2).count() == 0


def test_fingerprint_query(spark):
    docs = documents()[::-1]
    rows = {r.doc_id: r for r in queries.QUERIES["op6_fingerprints"](spark, SF).collect()}
    assert len(rows) == len(docs)
    made = fingerprints.fingerprints(pa.array([t for _, t in docs]))
    for i, (doc_id, text) in enumerate(docs):
        nxt, r = docs[(i + 1) % len(docs)][1], rows[doc_id]
        other = text[:len(text) - len(text) // 3] + nxt[:len(text) // 3]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(other.encode()).hexdigest())
        assert r.fingerprint == made[i] and r.edited_fingerprint == fingerprints.fingerprints(pa.array([other]))[0]
        assert r.near_next == fingerprints.likeness([made[i]], [made[(i + 1) % len(docs)]])[0]
    near = [r.near_edited for r in rows.values() if r.n_chars > 200]
    assert np.mean(near) > 0.6 and np.mean([r.near_next for r in rows.values()]) < 0.05


def test_edit_distance_is_exact():
    made = random.Random(5)
    def slow(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            row = [0] + [max(row[j] + 1 if x == b[j] else 0, row[j + 1], 0) for j in range(len(b))]
            for j in range(len(b)):
                row[j + 1] = max(row[j + 1], row[j])
        return row[-1]
    for _ in range(60):
        a, b = ("".join(made.choice("abc") for _ in range(made.randint(8, 64))) for _ in range(2))
        got = fingerprints._alike([(a, b)])[0]
        assert got in (0.0, pytest.approx(2 * slow(a, b) / (len(a) + len(b))))


def test_fingerprint_edges(edges, nothing):
    rows = fingerprints.fingerprint_table(edges).collect()
    assert len(rows) == len(edge_rows())
    by = defaultdict(set)
    for r in edge_rows():
        by[r[1] or ""].add(fingerprints.fingerprints(pa.array([r[1] or ""]))[0])
    assert all(len(v) == 1 for v in by.values())
    assert fingerprints.fingerprint_table(nothing).count() == 0
    assert fingerprints.fingerprint_table(edges.limit(1)).first()["near_next"] == 1.0


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in queries.QUERIES["op7_quality_classifier"](spark, sf).collect()}
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and 0 <= r.score <= 1 for d, r in rows.items())
    held = [(rows[d].predicted, q) for d, q in labels if rows[d].held_out]
    assert np.mean([p == q for p, q in held]) > 0.97


def test_quality_edges(spark, edges, nothing):
    labels = spark.createDataFrame([(1, 1), (4, 1), (49, 0), (34, 0), (None, 1), (37, None)], "doc_id long, quality int")
    space = quality.learn(edges, labels)
    assert len(quality.score_quality(edges, space).collect()) == len(edge_rows())
    assert quality.keep_good(edges, space).columns == edges.columns
    assert quality.score_quality(nothing, space).count() == 0
    none = quality.learn(edges, labels.limit(0))
    assert {r.score for r in quality.score_quality(edges, none).collect()} == {0.5}


def test_vote_is_exact():
    made = np.random.default_rng(1)
    vectors = quality._unit(made.standard_normal((2500, 8)).astype(np.float32))
    labels = (made.random(2500) < 0.5).astype(np.float32)
    space = quality.Space(*[None] * 4, vectors, labels)
    x = quality._unit(made.standard_normal((20, 8)).astype(np.float32))
    for row, got in zip(x, quality.vote(x, space)):
        cosine = vectors @ row
        best = np.argsort(-cosine)[:quality.NEIGHBOURS]
        share = np.maximum(cosine[best], 0).astype(float) ** 8
        assert got == pytest.approx((share * labels[best]).sum() / share.sum(), rel=1e-4)


def test_language_model_is_normalised():
    net = masked_lm.fresh_net()
    around = np.array([[1, 2, 3, masked_lm.WORDS]])
    every = masked_lm.log_probabilities(net, np.repeat(around, masked_lm.WORDS, 0), np.arange(masked_lm.WORDS))
    assert np.exp(every.astype(float)).sum() == pytest.approx(1, abs=1e-3)


def test_gradients():
    net = {k: v.astype(np.float64) for k, v in masked_lm.fresh_net().items()}
    around, targets = np.array([[1, 2, 3, 4], [5, 5, masked_lm.WORDS, 7]]), np.array([9, 70])
    found = masked_lm.gradients(net, around, targets)
    for name, at in (("embed", (5, 3)), ("place", (1, 2)), ("bias", (4,)), ("kind", (9, 1)), ("word", (70, 0)), ("word_bias", (70,))):
        loss = []
        for d in (1e-3, -1e-3):
            net[name][at] += d
            loss.append(-masked_lm.log_probabilities(net, around, targets).astype(float).sum())
            net[name][at] -= d
        assert found[name][at] == pytest.approx((loss[0] - loss[1]) / 2e-3, abs=2e-3)


def test_language_model_learns_both_sides(spark, edges, nothing):
    texts = [" ".join(f"a{i % 7} x{i % 7} b{i % 7}" for i in range(k, k + 400)) for k in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    model = masked_lm.train(docs, rounds=2)
    test = spark.createDataFrame([(0, texts[3]), (1, " ".join(random.Random(1).sample(texts[3].split(), 1200)))], "doc_id long, text string")
    right, shuffled = [r.mean_log_likelihood for r in masked_lm.score_documents(test, model).orderBy("doc_id").collect()]
    assert right > shuffled + 0.5
    rows = masked_lm.score_documents(edges, model).collect()
    assert len(rows) == len(edge_rows()) and all(r.log_likelihood == 0 and r.mean_log_likelihood is None for r in rows if r.n_words == 0)
    assert masked_lm.score_documents(nothing, masked_lm.train(nothing, rounds=1)).count() == 0


@pytest.mark.parametrize("rounds", [1, 2, 3, 5])
def test_rounds_mask_every_word(rounds):
    sizes = [1, 0, 2, 7, 1, 1, 40, 1, 1, 1, 3, 1, 1]
    first = np.concatenate(([0], np.cumsum(sizes)))
    hashes = np.random.default_rng(3).integers(0, 1 << 63, first[-1]).astype(np.uint64)
    rounds_of = [masked_lm.masked_places(hashes, first, r, rounds) for r in range(rounds)]
    assert set(np.concatenate(rounds_of)) == set(range(first[-1]))
    assert all(len(r) for r in rounds_of)
    single = [i for i, n in zip(first, sizes) if n == 1]
    assert all(set(r) & set(single) for r in rounds_of)     # texts of one word do not all wait for the same round


def test_rows_are_summed():
    made = np.random.default_rng(5)
    at, rows = made.integers(0, masked_lm.WORDS + 1, 500) // 64 * 64, made.standard_normal((500, 4))
    plain, got = np.zeros((masked_lm.WORDS + 1, 4)), np.zeros((masked_lm.WORDS + 1, 4))
    np.add.at(plain, at, rows)
    ids, sums = masked_lm._sums_by(at, rows)
    got[ids] = sums
    assert np.allclose(plain, got)


def test_words_in_buckets_have_their_own_probability(spark, monkeypatch):
    monkeypatch.setattr(masked_lm, "vocabulary", lambda counts: (np.zeros(0, np.uint64), np.zeros(0, np.int64)))   # all words are in buckets
    made = random.Random(4)
    texts = [" ".join(f"w{int(made.expovariate(0.005))}" for _ in range(200)) for _ in range(20)]
    docs = spark.createDataFrame([(None if i % 3 else 5, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    model = masked_lm.train(docs, rounds=1)
    counts = Counter(w for t in texts for w in t.split())
    net, known, ids, sizes, bucketed = model
    assert sizes.sum() == 4000 and bucketed.count() == len(counts)
    words = [*counts, "unheard"]
    data = " ".join(words).encode()
    hashes, _ = masked_lm.hashes_of(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    own = masked_lm.word_ids(hashes, known, ids)
    held = Counter()
    for w, b in zip(words, own):
        held[b] += counts[w]
    alone = masked_lm.log_probabilities(net, np.full((len(words), 4), masked_lm.WORDS), own)
    expected = {i: p + np.log(max(counts[w], 1) / (held[b] + 1)) for i, (w, b, p) in enumerate(zip(words, own, alone))}
    test = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string")
    got = {r.doc_id: r.log_likelihood for r in masked_lm.score_documents(test, model).collect()}
    assert got == pytest.approx(expected, abs=1e-4)
    double = spark.createDataFrame([(None, f"{words[0]} {words[0]}"), (None, f"{words[0]} {words[0]}"), (7, None)], "doc_id long, text string")
    rows = masked_lm.score_documents(double, model).collect()
    assert sorted(r.n_words for r in rows) == [0, 2, 2] and len({r.log_likelihood for r in rows if r.n_words}) == 1


def plain_components(rows, words, percent):
    sets = []
    for _, text in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
        sets.append({tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} - {()})
    label = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(i):
                if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) and label[i] != label[j]:
                    a, b = label[i], label[j]
                    label = [min(a, b) if x in (a, b) else x for x in label]
        break
    least = {}
    for (d, _), c in zip(rows, label):
        if d is not None:
            least[c] = min(d, least.get(c, d))
    return Counter((d, len(s), least.get(c) if s else d) for (d, _), s, c in zip(rows, sets, label))


def test_near_dedup_edges(edges, nothing):
    got = near_dedup.near_duplicates(edges, words=3, percent=85).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain_components([(r[0], r[1]) for r in edge_rows()], 3, 85)
    assert near_dedup.near_duplicates(nothing).count() == 0


def test_near_dedup_default_and_large_group(spark):
    made = random.Random(2)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(120):                                    # a large group of near copies
        own = base.copy()
        own[made.randrange(150)] = f"v{i}"
        rows.append((i, " ".join(own)))
    rows += [(200 + i, " ".join(f"u{made.randrange(4000)}" for _ in range(60))) for i in range(60)]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain_components(rows, 5, 80)


def test_near_dedup_crowded_region(spark):
    """More documents begin alike than a node is compared with, none of them linked; each eighth has one near copy."""
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(240):
        own = base.copy()
        own[60:90] = [f"v{i}_{k}" for k in range(30)]
        rows.append((i, " ".join(own)))
        if i % 8 == 0:
            own[i % 50] = "changed"
            rows.append((1000 + i, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = near_dedup.near_duplicates(docs, reach=1).collect()
    wanted = plain_components(rows, 5, 80)
    assert sum(c != d for d, _, c in wanted) == 30
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == wanted


def test_crowded_pairs_lose_no_link(spark):
    made = random.Random(3)
    common = [made.randrange(1 << 64) for _ in range(100)]
    sets = {f"n{i:03d}".encode(): {c for c in common if made.random() < 0.95} | {made.randrange(1 << 64) for _ in range(made.randrange(8))} for i in range(80)}
    held = spark.createDataFrame([(n, np.array(sorted(s), np.uint64).tobytes()) for n, s in sets.items()], "node binary, shingles binary")
    links = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    for label in ([], [(n, b"n000") for n in list(sets)[:30]]):
        pairs = near_dedup.crowded_pairs(held, spark.createDataFrame(label, "node binary, label binary"), 85)
        got = [(bytes(r.a), bytes(r.b)) for r in near_dedup.confirmed(pairs, held, 85).collect()]
        joined = {n for n, _ in label}
        assert len(got) == len(set(got)) and set(got) == {(a, b) for a, b in links if not {a, b} <= joined}
    assert 0 < len(links) < 80 * 79 / 2


def test_components_in_batches(spark):
    chain = [(f"{i:04d}".encode(), f"{i + 1:04d}".encode()) for i in range(60) if i != 30] + [(b"0040", b"0003")]
    links = spark.createDataFrame(chain, "a binary, b binary").repartition(5)
    for batch in (8, 1 << 20):
        got = {bytes(r.node): bytes(r.label) for r in components.components(links, batch).collect()}
        assert len(got) == 61 and set(got.values()) == {b"0000"}
    assert components.components(links.limit(0)).count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = {r.doc_id for r in quality.score_quality(docs, quality.learn(docs, spark.read.parquet(f"{SF}/labels.parquet"))).where("predicted = 1").collect()}
    kept, seen = [], set()
    for doc_id, text in documents():
        key = " ".join(text.replace("\x0b", " ").split()) if text.strip() == text else text
        if doc_id in good and key not in seen:
            seen.add(key)
            kept.append((doc_id, text))
    step = corpus_pipeline.STAGES
    first = step[0][1](spark, docs, SF)
    assert first.columns == docs.columns and {r.doc_id for r in first.collect()} == good
    second = step[1][1](spark, first, SF)
    assert sorted(r.doc_id for r in second.collect()) == [d for d, _ in kept]
    third = step[2][1](spark, second, SF)
    wanted = {c for _, _, c in plain_components(kept[:300], 5, 80)}
    small = step[2][1](spark, second.where(second.doc_id <= kept[299][0]), SF)
    assert {r.doc_id for r in small.collect()} == wanted
    fourth = step[3][1](spark, third, SF)
    taken = Counter(r.doc_id for r in fourth.collect())
    assert fourth.columns == docs.columns and max(taken.values()) <= 2
    words = {r.doc_id: r for r in mixing.sizes(third).withColumnRenamed("id", "doc_id").collect()}
    assert abs(sum(words[d]["size"] * n for d, n in taken.items()) / (1.5 * sum(r["size"] for r in words.values())) - 1) < 0.02
    last = corpus_pipeline.run(spark, SF).collect()
    assert Counter(r.doc_id for r in last) == taken and all(r.lossless for r in last)


def test_edits_of_repeated_lines():
    line = "the same line of text again and again, word for word\n"
    for text in (line * 400, "ab, " * 9000, line * 30 + "x" * 500 + line * 300):
        for at in (10, len(text) // 2, len(text) - 20):
            one, two = fingerprints.fingerprints(pa.array([text, text[:at] + "EDIT" + text[at:]]))
            assert fingerprints.likeness([one], [two])[0] > 0.5


def test_low_likeness_is_refused(edges):
    with pytest.raises(ValueError):
        near_dedup.near_duplicates(edges, percent=50)


def test_changes_are_averaged_over_the_tasks_that_moved_a_number():
    import pandas as pd

    def row(task, weight, values):
        change = np.array(values, np.float32)
        return ("word", 0, task, weight, change.tobytes(), np.packbits(change != 0).tobytes())
    rows = pd.DataFrame([row(0, 1.0, [2, 0, 0]), row(1, 3.0, [6, 4, 0])], columns=["name", "block", "learner", "weight", "change", "met"])
    assert np.frombuffer(masked_lm._average(rows)["change"][0], np.float32).tolist() == [5.0, 4.0, 0.0]


def test_lm_query_against_a_plain_version(spark):
    """The registered query against counts, training and scores in one process, without Spark."""
    lm = masked_lm
    keys = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id", "xxhash64(doc_id, text)").collect()}
    docs = sorted(documents(), key=lambda d: keys[d[0]])
    words = {i: lm.hashes_of(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0] for i, t in docs}
    counts = Counter(h for own in words.values() for h in own.tolist())
    top = sorted(counts, key=lambda h: (-counts[h], int(np.uint64(h).astype(np.int64))))[:lm.WORDS - lm.BUCKETS]
    rank = {h: i for i, h in enumerate(top)}
    place = lambda h: rank.get(h, lm.WORDS - lm.BUCKETS + h % lm.BUCKETS)
    sizes = Counter()
    for h, n in counts.items():
        sizes[place(h)] += n
    net = lm.fresh_net()
    for round_ in range(lm.ROUNDS):
        past, held, waiting = {k: np.zeros_like(v) for k, v in net.items()}, [], 0
        from tradewind.llm.common import text_chunks
        chunks = [(a, b) for a, b, *_ in text_chunks(pa.array([t for _, t in docs]))]
        for n, (a, b) in enumerate(chunks):
            own = [words[i] for i, _ in docs[a:b]]
            first, hashes = np.cumsum([0, *map(len, own)]), np.concatenate(own)
            ids = np.array([place(h) for h in hashes.tolist()])
            at = lm.masked_places(hashes, first, round_, lm.ROUNDS)
            held.append((lm.contexts(ids, first)[at], ids[at]))
            waiting += len(at)
            if waiting >= lm._BATCH or n == len(chunks) - 1:
                around, targets = (np.concatenate([h[k] for h in held]) for k in (0, 1))
                for s in range(0, len(targets), lm._BATCH):
                    lm.train_step(net, past, around[s:s + lm._BATCH], targets[s:s + lm._BATCH], 0.1)
                held, waiting = [], 0
    want = {}
    for i, own in words.items():
        ids = np.array([place(h) for h in own.tolist()], np.int64)
        chances = lm.log_probabilities(net, lm.contexts(ids, np.array([0, len(own)])), ids).astype(float)
        rare = [np.log(counts[h] / (sizes[p] + 1)) for h, p in zip(own.tolist(), ids.tolist()) if p >= lm.WORDS - lm.BUCKETS]
        want[i] = (len(own), chances.sum() + sum(rare))
    got = {r.doc_id: (r.n_words, r.log_likelihood) for r in queries.QUERIES["op2_lm_scoring"](spark, SF).collect()}
    assert got.keys() == want.keys() and all(got[i][0] == want[i][0] for i in want)
    assert all(abs(got[i][1] - want[i][1]) <= 2e-3 * abs(want[i][1]) + 1e-3 for i in want)


def test_lm_does_not_depend_on_partitions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id % 5 = 0")
    scores = [{r.doc_id: r.log_likelihood for r in masked_lm.score_documents(d, masked_lm.train(d, words=1 << 15)).collect()}
              for d in (docs.repartition(2), docs.repartition(17))]
    one, two = (np.array([s[i] for i in sorted(scores[0])]) for s in scores)
    assert np.allclose(one, two, rtol=1e-3, atol=1e-2)


def test_words_met_again_after_the_memo_was_renewed(monkeypatch):
    monkeypatch.setattr(token_files, "_KNOWN", 40)
    tokenizer, made = Tokenizer.from_file(BYTES), random.Random(5)
    for _ in range(30):
        texts = [" ".join(made.choice(["the", "of", f"w{made.randrange(60)}x", "é" * made.randrange(1, 40), "y" * 80, "z" * made.randrange(60, 70)]) for _ in range(40)) for _ in range(3)]
        assert token_files.encode_batch(pa.array(texts, pa.large_string()), BYTES).to_pylist() == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_lm_learners_hold_word_ids(spark):
    """Words are looked up once: a round reads ids, and masks and cuts the documents as it would from their texts."""
    from tradewind.llm.common import text_chunks
    lm = masked_lm
    texts = ["a b a c", None, "", "B c " * 300_000, "d", " é a\x0bb ", "c c d a b"]
    docs = spark.createDataFrame([(i % 5, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    counts = lm.count_words(docs)
    known, ids = lm.vocabulary(counts)
    dealt = lm.learners(docs, counts, known, ids, words=100_000)
    assert dealt.columns == ["learner", "size", "sum", "ids"]
    wanted, got, lengths = Counter(), Counter(), []
    for t in texts:
        data = np.frombuffer((t or "").encode(), np.uint8)
        hashes, first = lm.hashes_of(data, np.array([0, len(data)]))
        wanted[(lm.word_ids(hashes, known, ids).tobytes(), lm.masked_places(hashes, first, 0, 2).tobytes())] += 1
        lengths.append(len(data))
    table = dealt.toArrow().combine_chunks().to_batches()[0]
    for own, first, sums in lm.id_chunks(table):
        masked = lm.places_of_round(sums, first, 0, 2)
        for a, b in zip(first, first[1:]):
            got[(own[a:b].tobytes(), (masked[(masked >= a) & (masked < b)] - a).tobytes())] += 1
    assert got == wanted and sorted(table.column(1).to_pylist()) == sorted(lengths)
    cuts = [(a, b) for a, b, *_ in text_chunks(pa.array(["x" * n for n in table.column(1).to_pylist()]))]
    assert [b - a for a, b in cuts] == [len(sums) for _, _, sums in lm.id_chunks(table)]
    first = next(lm.id_chunks(table.slice(2, 3)))[0]
    assert np.array_equal(first[:5], np.frombuffer(table.column(3)[2].as_py(), "<u2")[:5])


@pytest.mark.parametrize("most", [1, 8, 9, 10, 200, 3000])
def test_rows_are_summed_as_reduceat_does(most):
    made = np.random.default_rng(most)
    ids = made.permutation(np.repeat(made.permutation(300)[:40], made.integers(1, most + 1, 40)))
    rows = made.standard_normal((len(ids), 32)).astype(np.float32)
    order = np.argsort(ids, kind="stable")
    at, starts = np.unique(ids[order], return_index=True)
    found, sums = masked_lm._sums_by(ids, rows)
    assert np.array_equal(found, at) and np.array_equal(sums, np.add.reduceat(rows[order], starts, axis=0))
    again = masked_lm._sums_by(np.concatenate((ids, ids + 300)), rows, np.tile(np.arange(len(ids)), 2))
    assert np.array_equal(again[0], np.concatenate((at, at + 300))) and np.array_equal(again[1], np.concatenate((sums, sums)))


def test_words_are_found_by_the_beginnings_of_hashes():
    made = np.random.default_rng(2)
    known = np.unique(np.concatenate((made.integers(0, 1 << 63, 500), made.integers(0, 30, 20), (1 << 62) + made.integers(0, 30, 20), [2**63 - 1])).astype(np.uint64) * np.uint64(2))
    ids = made.permutation(len(known))
    hashes = np.concatenate((known, known + np.uint64(1), known - np.uint64(1), np.array([0, 2**64 - 1], np.uint64)))
    rank = dict(zip(known.tolist(), ids.tolist()))
    bucket = masked_lm.WORDS - masked_lm.BUCKETS
    for n in (len(known), 1, 0):
        wanted = [rank[h] if h in known[:n].tolist() else bucket + h % masked_lm.BUCKETS for h in hashes.tolist()]
        assert masked_lm.word_ids(hashes, known[:n], ids[:n]).tolist() == wanted


def test_large_scores_stay_finite():
    net = masked_lm.fresh_net()
    net["kind"] *= 3000
    net["word"] *= 3000
    made = np.random.default_rng(1)
    around, targets = made.integers(0, masked_lm.WORDS + 1, (9000, 4)), made.integers(0, masked_lm.WORDS, 9000)
    scores = masked_lm.log_probabilities(net, around, targets)
    assert np.isfinite(scores).all() and (scores <= 0).all()
    assert all(np.isfinite(g).all() for g in masked_lm.gradients(net, around, targets).values())


def test_common_words_of_buckets_are_not_joined(spark, monkeypatch):
    """Scores are the same whether a bucket's words are broadcast with their counts, joined, or some of each."""
    lm = masked_lm
    monkeypatch.setattr(lm, "vocabulary", lambda counts: (np.zeros(0, np.uint64), np.zeros(0, np.int64)))   # all words are in buckets
    made = random.Random(8)
    texts = [" ".join(f"w{int(made.expovariate(0.02))}" for _ in range(100)) for _ in range(30)] + [None, ""]
    docs = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    model = lm.train(docs, rounds=1)
    most = sorted(Counter(w for t in texts for w in (t or "").split()).values())
    assert most[0] == 1 and most[-1] > 20
    got, stage, joined = [], lm.stage, []

    def staged(df, label):
        df = stage(df, label)
        joined.append(df.selectExpr("sum(size(rare))").first()[0])
        return df
    monkeypatch.setattr(lm, "stage", staged)
    for most in (1 << 20, 200, 0.5):
        monkeypatch.setattr(lm, "COMMON", most)
        got.append(sorted((r.doc_id, r.n_words, r.log_likelihood) for r in lm.score_documents(docs, model).collect()))
    for other in got[1:]:
        assert [r[:2] for r in got[0]] == [r[:2] for r in other]
        assert np.allclose([r[2] for r in got[0]], [r[2] for r in other], rtol=1e-12)
    once = sum(n == 1 for n in Counter(w for t in texts for w in (t or "").split()).values())
    assert joined[0] == once < joined[1] < joined[2] == 3000
