"""SimHash groups, conversation repair and the filter audit against brute force, and on odd inputs."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.llm import conversation_repair, filter_audit, queries, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fingerprint(text):
    import xxhash

    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_components(points):
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= 4
    root = np.arange(len(points))
    while True:
        low = np.array([root[near[i]].min() for i in range(len(points))])
        if (low == root).all():
            return root
        root = low


@pytest.fixture(scope="module")
def similar():
    """Texts with copies, near copies that chain, short and odd ones."""
    rng = random.Random(11)
    out = [None, "", " \t\n", "One", "one", "a b c", "A b C", "É é", "日本語 😀 x y", "x" * 5000, "w " * 3000]
    for _ in range(40):
        words = [f"w{rng.randrange(200)}" for _ in range(rng.randrange(60, 400))]
        out.append(" ".join(words))
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"v{rng.randrange(50)}"
            out.append(" ".join(words).upper() if rng.random() < 0.2 else " ".join(words))
    return out + out[12:20]


@pytest.mark.parametrize("shard,block", [(4096, 1 << 17), (8, 1 << 17), (16, 8)])
def test_simhash_groups(spark, similar, shard, block):
    """Also with many small shards, and with all shards too large for one task."""
    rows = [(i, t, "n", 1) for i, t in enumerate(similar)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string, point int").repartition(3)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(df, shard=shard, block=block).collect()}
    points = np.array([brute_fingerprint(t) for t in similar], np.uint64)
    root = brute_components(points)
    assert got == {i: (f"{int(points[i]):016x}", int(root[i])) for i in range(len(similar))}
    assert len(set(root)) < len(similar) - 20 and got[0][0] == "0" * 16


def test_simhash_ids(spark, similar, monkeypatch):
    """Null ids, repeated ids and rows, a text that very many rows have, and an empty table."""
    monkeypatch.setattr(simhash, "TOGETHER", 3)
    rows = [(None, "alone here"), (None, "alone here"), (7, similar[20]), (None, similar[20]), (7, similar[20]), (3, similar[21]), *((100 + k, "") for k in range(20))]
    got = collections.Counter((r.doc_id, r.component_id) for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    linked = np.bitwise_count(np.uint64(brute_fingerprint(similar[20])) ^ np.uint64(brute_fingerprint(similar[21]))) <= 4
    least = 3 if linked else 7
    assert got == collections.Counter([(None, None)] * 2 + [(7, least)] * 2 + [(None, least), (3, 3)] + [(100 + k, 100) for k in range(20)])
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_pieces_of_a_long_text(monkeypatch):
    rng = random.Random(2)
    text = " ".join(f"w{rng.randrange(99)}" for _ in range(3000))
    want = brute_fingerprint(text)
    for piece in (1, 7, 100, 4096):
        monkeypatch.setattr(simhash, "PIECE", piece)
        assert simhash.fingerprint(text.encode()) == want


def test_vantage_point_search():
    """Clumps in which nearly all link, chains and lone points, against all pairs."""
    rng = np.random.default_rng(4)
    flip = lambda x, k: x ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, k).astype(np.uint64))
    points = [x for x in rng.integers(0, 2**63, 300, np.uint64)]
    for center in points[:6]:
        points += [flip(center, rng.integers(1, 7)) for _ in range(150)]
    points = np.unique(np.array(points, np.uint64))
    every = np.arange(len(points))
    assert (simhash.search(points, every, every) == brute_components(points)).all()


# conversations


def brute_faults(rows):
    """(role, text, fault) of rows in order."""
    seen, out = set(), []
    for role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def brute_repair(rows):
    """The least (cost, audit, text) over all edits, by whole prefixes of edits for each state."""
    order = {"": "su", "s": "u", "u": "a", "a": "u"}

    def put_in(best):
        for _ in range(3):
            for state, (cost, audit, lines) in list(best.items()):
                to = "a" if state == "u" else "u"
                way = (cost + 2, audit + "I", [*lines, {"u": "user:", "a": "assistant:"}[to]])
                best[to] = min(best.get(to, way), way)
        return best

    best = {"": (0, "", [])}
    for role, text, fault in brute_faults(rows):
        new = {}
        # insertions before a row: up to three, each from every state
        ways = [(s, v) for s, v in best.items()]
        for s, (cost, audit, lines) in list(ways):
            state, value = s, (cost, audit, lines)
            for _ in range(3):
                to = "a" if state == "u" else "u"
                value = (value[0] + 2, value[1] + "I", [*value[2], {"u": "user:", "a": "assistant:"}[to]])
                state = to
                ways.append((state, value))
        for s, (cost, audit, lines) in ways:
            out = [(s, (cost + 3, audit + "D", lines))]
            if fault not in ("blank", "duplicate"):
                more = int(fault == "truncated")
                if role[:1] and role[:1] in order[s]:
                    out.append((role[:1], (cost + more, audit + "K", [*lines, f"{role}:{text}"])))
                to = "a" if s == "u" else "u"
                out.append((to, (cost + 2 + more, audit + "R", [*lines, {"u": "user:", "a": "assistant:"}[to] + text])))
            for to, way in out:
                new[to] = min(new.get(to, way), way)
        best = new
    ends = []
    for s, (cost, audit, lines) in best.items():
        n = {"": 0, "s": 2, "u": 1, "a": 0}[s]
        ends.append((cost + 2 * n, audit + "I" * n, [*lines, *{0: [], 1: ["assistant:"], 2: ["user:", "assistant:"]}[n]]))
    cost, audit, lines = min(ends)
    return cost, audit, "\n".join(lines)


def report(turns, rows):
    faults = collections.Counter(f for _, _, f in brute_faults(rows))
    known = [t for t in turns if t is not None]
    pairs = [a[0][:1] + b[0][:1] for a, b in itertools.pairwise(rows)]
    cost, audit, text = brute_repair(rows)
    return (max(known) - min(known) + 1 - len(set(known)) if known else 0, faults["blank"], faults["duplicate"], faults["truncated"], sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest())


def got_reports(rows):
    reports = conversation_repair.repairs(rows)
    digests = {r.conv_id: r.repaired_sha256 for r in conversation_repair.digests(conversation_repair.repaired(rows, reports)).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, digests.get(r.conv_id, empty)) for r in reports.collect()}


def test_repair_against_brute_force(spark):
    rng = random.Random(6)
    talks = {}
    for conv in range(150):
        n = rng.randrange(1, 14)
        talks[conv] = [(t * rng.choice([1, 1, 1, 2]), rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", "u", "S"]), rng.choice(["Hi.", "Go on", "  ", "", "Why?\n", "So!"]) + rng.choice(["", f" {t}."])) for t in range(n)]
        talks[conv] = sorted({t: (t, r, x) for t, r, x in talks[conv]}.values())
    talks[None] = [(0, "user", "What?"), (1, "assistant", "This.")]
    talks[900] = [(t, "ua"[t % 2], f"Turn {t}.") if t % 7 else (t, "user", "again") for t in range(3000)]
    rows = [(c, t, r, x, 1, "y") for c, talk in talks.items() for t, r, x in talk]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, `a.b` int, digest string")
    small = {c: report([t for t, _, _ in talk], [(r, x) for _, r, x in talk]) for c, talk in talks.items()}
    assert got_reports(df) == small


def test_repair_of_odd_rows(spark):
    """Null turns come first, null roles and texts are a blank, repeated rows follow each other, and the table is small."""
    rows = [(1, None, "user", "First."), (1, 4, None, "Who?"), (1, 6, "assistant", None), (1, 9, "assistant", "Yes."), (1, 9, "assistant", "Yes."), (2, None, None, None), (3, 5, "system", "Only.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    talks = {1: ([None, 4, 6, 9, 9], [("user", "First."), (" ", "Who?"), ("assistant", " "), ("assistant", "Yes."), ("assistant", "Yes.")]), 2: ([None], [(" ", " ")]), 3: ([5], [("system", "Only.")])}
    assert got_reports(df) == {c: report(*t) for c, t in talks.items()}
    none = df.withColumn("there", F.lit(False))
    assert set(got_reports(none).values()) == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert got_reports(df.limit(0)) == {}
    turns = conversation_repair.repaired(df, conversation_repair.repairs(df)).where("conv_id = 1").orderBy("position").collect()
    assert [r.position for r in turns] == list(range(len(turns))) and "\n".join(f"{r.role}:{r.text}" for r in turns) == brute_repair(talks[1][1])[2]
    assert "".join(r.edit for r in turns) == brute_repair(talks[1][1])[1].replace("D", "")


def test_damage(spark):
    rows = [(c, t, r, x) for c in (*range(12), None) for t, r, x in ((0, "system", "A. b!"), (1, "assistant", "C?"), (None, None, None))]
    got = collections.Counter(tuple(r) for r in conversation_repair.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect())
    want = collections.Counter()
    for c, t, r, x in rows:
        name = lambda v: " " if v is None else str(v)
        f, r, x = zlib.crc32(f"{name(c)}:{name(t)}".encode()) % 20, name(r), name(x)
        r, x = "user" if f == 4 else r, {1: "", 2: re.sub("[.!?]", "", x)}.get(f, x)
        want[(c, t, None, None, False) if f == 0 else (c, t, r, x, True)] += 1 + (f == 3)
    assert got == want and len({k[4] for k in got}) == 2


# filters


def test_filter_audit_against_brute_force(spark):
    rng = random.Random(8)
    texts = [None, "", "a b " * 150, "A" * 900, " ".join(f"w{i}" for i in range(230)), " ".join(f"w{i}" for i in range(230)) + " #", "x " * 50 + "%"]
    texts += [" ".join(rng.choice(["Up", "low", f"w{rng.randrange(400)}", "$5"]) for _ in range(rng.randrange(150, 260))) for _ in range(20)]
    docs = [(rng.choice([None, i, i, 3]), rng.choice(texts), rng.choice(["a", "b", "", None]), 0) for i in range(150)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 150, 2)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, `a.b` int").withColumn("mask", F.lit("x"))
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in filter_audit.audit(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}

    def failed(i, t):
        w = WORD.findall(t)
        out = "A" * (len(w) < 200) + "B" * (100 * len(set(w)) < 50 * len(w)) + "C" * (100 * len(re.findall("[A-Z]", t)) > 2 * len(t)) + "D" * bool(re.search("[#$%&*|]", t))
        return out + "E" * (i is not None and any(j is not None and j < i and (u or "") == t for j, u, _, _ in docs))

    rows = [(s or "", failed(i, t or ""), any(q == 1 for j, q, _ in labels if j == i and i is not None), any(x == 1 for j, _, x in labels if j == i and i is not None)) for i, t, s, _ in docs]
    want = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            for k, x in enumerate(order):
                there = [r for r in own if not set(r[1]) & set(order[:k])]
                gone = [r for r in there if x in r[1]]
                want[part, order, k + 1] = [len(there) - len(gone), len(gone), sum(x in r[1] for r in own) - len(gone), sum(r[1] == x for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone)]
    totals = collections.Counter()
    for (part, order, step), v in want.items():
        totals[part, order[step - 1]] += v[1]
    assert got == {k: (*v, totals[k[0], k[1][k[2] - 1]]) for k, v in want.items()}
    assert filter_audit.audit(df.limit(0), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).count() == 0


def test_new_queries_match_sql(spark):
    import os

    duckdb = pytest.importorskip("duckdb")
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no test tables")
    con = duckdb.connect()
    for t in ("documents", "labels", "conversations"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    for name in ("op12_conversation_repair", "op13_filter_audit"):
        got = queries.QUERIES[name](spark, sf)
        r = con.execute(queries.ORACLE[name])
        cols = [c[0] for c in r.description]
        assert sorted(got.columns) == sorted(cols)
        assert collections.Counter(tuple(x) for x in got.select(cols).collect()) == collections.Counter(r.fetchall()), name
