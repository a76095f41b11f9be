"""Exact dedup, mixing, chat formatting and secret scans against plain Python."""

import hashlib
import re
from collections import defaultdict

import duckdb
import pytest
from check_oracles import compare, duck
from conftest_llm import SF, edge_rows

from tradewind.llm import chat, exact_dedup, mixing, queries, secrets


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    n, _, problem = compare(spark, duck(SF), name, queries.QUERIES[name], queries.SQL[name], SF)
    assert problem is None and n > 0


def plain_groups(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")].append(r[0])
    return {t: (min((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}


@pytest.mark.parametrize("most", [32 << 20, 1 << 15])
def test_exact_dedup_edges(edges, nothing, most):
    want = sorted(((r[0], *(g := plain_groups(edge_rows())[(t := re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or ""))]), r[0] == g[0],
                    hashlib.sha256(t.encode()).hexdigest()) for r in edge_rows()), key=str)
    got = exact_dedup.exact_dedup(edges, max_filter_bytes=most)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert exact_dedup.exact_dedup(nothing).count() == 0


def test_drop_repeats(edges, nothing):
    got = exact_dedup.drop_repeats(edges)
    assert got.columns == edges.columns
    assert sorted((r.doc_id or -1) for r in got.collect()) == sorted((k if k is not None else -1) for k, _ in plain_groups(edge_rows()).values())
    assert exact_dedup.drop_repeats(nothing).count() == 0


def test_filter_slices(spark):
    docs = spark.range(40_000).selectExpr("id AS doc_id", "concat('text ', id % 39000) AS text")
    got = exact_dedup.exact_dedup(docs, max_filter_bytes=1 << 15)
    assert got.where("kept").count() == 39_000 and got.where("group_size = 2").count() == 2_000


def test_only_possible_repeats_are_grouped(spark):
    docs = spark.range(50_000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    hashes = docs.selectExpr("xxhash64(text) AS h").cache()
    flagged = exact_dedup.flag_possible_repeats(hashes, "h", 50_000, 32 << 20, hashes)
    assert flagged.where("_maybe").count() < 1_500


def test_mixing_edges(edges, nothing):
    rows = mixing.taken_words(edges).collect()
    words = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in edge_rows()]
    assert sorted(r["size"] for r in rows) == sorted(words)
    per = defaultdict(lambda: [0, None, None])
    for r in rows:
        assert 0 <= r.taken <= 2 * r["size"]
        per[r.source_size][0] += r.taken
        per[r.source_size][1] = r.target
    for size, (taken, target, _) in per.items():
        assert target <= 2 * size and abs(taken - target) <= 2
    assert abs(sum(t for t, _, _ in per.values()) - 1.5 * sum(words)) <= len(per) + 1
    assert sorted(map(tuple, mixing.taken_words(edges.repartition(7)).collect()), key=str) == sorted(map(tuple, rows), key=str)
    assert mixing.taken_words(nothing).count() == 0


def test_mix_order_is_fair(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id < 1500 THEN 'a' WHEN id < 2400 THEN 'b' ELSE 'c' END AS source",
                                        "repeat('w ', cast(1 + id % 7 AS int)) AS text")
    sized = mixing.sizes(docs)
    targets = mixing.source_targets(sized)
    picks = mixing.mix(sized, targets, block_rows=100).collect()
    assert [p.position for p in picks] == sorted(p.position for p in picks)
    at = 0
    for p in picks:
        assert p.position == at
        at += p.taken
    source, goal = {r.row: r.source for r in sized.collect()}, {r.source: r.target for r in targets.collect()}
    half = defaultdict(int)
    for p in picks:
        if p.finish <= 0.5:
            half[source[p.row]] += p.taken
    assert all(abs(half[s] / goal[s] - 0.5) < 0.02 for s in goal)


CHAT = [(1, 0, "system", "be kind"), (1, 1, "user", "hi <s> there"), (1, 2, "assistant", "a [INST] b \\ <\\/s> </s"), (1, 3, "user", None),
        (1, 4, "assistant", "word " * 300), (1, 5, "assistant", "tail <"), (1, 5, "assistant", "tail <"), (2, None, "assistant", "last"), (2, 3, None, ""),
        (None, 0, "user", "null conversation"), (3, 0, "system", "alone")]


def plain_turns(rows):
    out = defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[2] or "", r[3] or "")):
        out[c].append((r or "", x or ""))
    return out


@pytest.mark.parametrize("budget,history", [(512, 128), (40, 16), (9, 3)])
def test_chat_round_trip(spark, budget, history):
    turns = spark.createDataFrame([(*r, "x", 1) for r in CHAT], "conv_id long, turn long, role string, text string, window string, loss int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")      # several ranges, so few turns would be one
    windows = chat.format_windows(turns, budget=budget, history=history)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = plain_turns(CHAT)
    got = {r.conv: r for r in chat.read_windows(windows).collect()}
    assert set(got) == set(want)
    for c, turns_ in want.items():
        assert [(t.role, t.text) for t in got[c].turns] == turns_
        assert list(got[c].loss) == [x for r, x in turns_ if r == "assistant"]
    for w in windows.where("conv = 1").collect():
        assert w.text.startswith("<s>[INST]system[/INST]be kind</s>")          # every window keeps the system turn
        assert w.window == 0 or w.repeated >= 1
    if budget == 40:
        assert windows.where("conv = 1").count() > 1 and windows.agg({"repeated": "max"}).first()[0] > 1
    assert chat.read_windows(chat.format_windows(turns.limit(0))).count() == 0


def test_chat_query(spark):
    rows = [tuple(r) for r in duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF}/conversations.parquet'").fetchall()]
    said = "</s>[INST] ok [/INST]"
    want = plain_turns([*rows, (-1, 0, "user", said), (-1, 1, "assistant", said)])
    got = {r.conv_id: r for r in queries.QUERIES["op5_chat_formatting"](spark, SF).collect()}
    assert set(got) == set(want)
    for c, turns in want.items():
        loss = "".join(x for r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def plain_secrets(text):
    found = []
    for n, rule in enumerate(secrets.BASE_RULES + secrets.MORE_RULES):
        regex = r"[0-9a-f]+" if rule.kind == "hex" else rule.regex
        for m in re.finditer(regex, text, re.ASCII):
            if len(m.group(rule.group)) >= rule.least:
                found.append((m.start(), n, m.end(), rule.kind))
    return [(s, k, e) for s, _, e, k in sorted(found)]


def test_secret_edges(edges, nothing):
    got = sorted(((r.doc_id, [tuple(s) for s in r.secrets]) for r in secrets.find_secrets(edges).collect()), key=str)
    assert got == sorted(((r[0], plain_secrets(r[1] or "")) for r in edge_rows()), key=str)
    assert any(len(s) >= 3 for _, s in got)
    assert secrets.find_secrets(nothing).count() == 0


def test_secret_query(spark):
    docs = dict(duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SF}/documents.parquet'").fetchall())
    got = queries.QUERIES["op8_secret_scans"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        spans = plain_secrets(docs[r.doc_id])
        base = [s for s in spans if s[1] in ("assign", "access", "hex")]
        assert r.spans == ",".join(f"{k}:{s}:{e}" for s, k, e in spans)
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, k, e in base).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for _, k, _ in base) for x in ("assign", "access", "hex"))


def test_trigram_queries():
    assert secrets.trigram_query("AKIA[A-Z0-9]+") == {frozenset({"aki", "kia"})}
    assert secrets.trigram_query("(foo|barn)x") == {frozenset({"foo", "oox"}), frozenset({"bar", "arn", "rnx"})}
    assert secrets.trigram_query("[0-9a-f]{24,}") == frozenset() == secrets.trigram_query("ab?c|abcd")
    assert secrets.trigram_query("ab[0-9]+cde") == {frozenset({"cde"})}


def test_many_sources_of_one_document(spark):
    docs = spark.range(6_000).selectExpr("id AS doc_id", "concat('host', id) AS source", "'a b c' AS text")
    rows = mixing.taken_words(docs).collect()
    assert len(rows) == 6_000 and all(r["size"] == r["source_size"] == 3 and r["taken"] <= 6 for r in rows)
    assert abs(sum(r["taken"] for r in rows) / 27_000 - 1) < 0.05


def test_mix_documents_edges(edges, nothing):
    mixed = mixing.mix_documents(edges)
    assert mixed.columns == edges.columns and 0 < mixed.count() <= 2 * edges.count()
    assert mixing.mix_documents(nothing).count() == 0
