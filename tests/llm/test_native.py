"""The operators made of DataFrame operations: sharding, line dedup, chat, quality."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd

from tillpoint.llm import chat, linededup, quality, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_shards(spark, docs, data, none, tmp_path):
    got = sharding.sharded_documents(docs, 3).collect()
    key = lambda i, t: (i is not None, i or 0, t)
    want = sorted(((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in data), key=lambda r: key(*r[:2]))
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=lambda r: key(*r[:2])) == want
    for s in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    assert {r["shard"] for r in got} <= {0, 1, 2} and {r["law"] for r in got} == {"bytes"}
    assert sharding.sharded_documents(none).count() == 0
    path = str(tmp_path / "map")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sharding.shard(docs, 3, map_path=path)
    first = {r["vslot"]: r["shard"] for r in sharding.load_map(spark, path).collect()}
    loads = sharding.slot_loads(sharding.slotted(docs)).collect()
    grown = sharding.rebalanced(first, loads, 4)
    moved = [v for v in grown if grown[v] != first[v]]
    assert moved and {grown[v] for v in moved} == {3}
    size = {r["vslot"]: r["bytes"] for r in loads}
    after = [sum(size.get(v, 0) for v in grown if grown[v] == s) for s in range(4)]
    assert max(after) < 1.1 * min(after)
    sharding.store_map(sharding.map_frame(spark, grown, loads, 2), path)
    assert {r["vslot"]: r["shard"] for r in sharding.load_map(spark, path).collect()} == grown
    assert {r["vslot"]: r["shard"] for r in sharding.load_map(spark, path, 1).collect()} == first
    shrunk = sharding.rebalanced(grown, loads, 2)
    assert set(shrunk.values()) == {0, 1}


def test_line_dedup_matches_sql(docs, data, none):
    unique = [r for r in data if r[0] is not None and r[0] != 600]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(unique, columns=["doc_id", "text"]))
    want = sorted(con.execute(linededup.ORACLE_SQL).fetchall())
    got = linededup.deduplicated_lines(docs.filter("doc_id is not null and doc_id != 600")).collect()
    assert sorted((r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in got) == want
    assert any(r["n_removed"] for r in got) and any(r["n_removed"] == 0 for r in got)
    out = linededup.remove_repeated_chunks(docs)
    assert out.columns[: len(docs.columns)] == docs.columns and out.count() == len(data)
    assert linededup.remove_repeated_chunks(none).count() == 0


def test_planted_passages_go(spark):
    import corpus_pipeline

    passages = {n: [f"line {k} of the passage of {n}" for k in range(n)] for n in range(2, 7)}
    passages[7] = ["a paragraph", "", " ", "another one", "", "and a third"]
    alone = lambda i, k: f"foreign line {k} of document {i}"
    data = []
    for n, p in passages.items():
        data += [(10 * n + i, [alone(10 * n + i, 0), *p, alone(10 * n + i, 1)]) for i in range(3)]
    data += [(100, ["same", "same", "same", "same", "end"]), (101, ["alone", "line 0 of the passage of 2", "stays"]), (102, ["x", "y"]), (103, ["x", "y", "z"]), (104, ["y", "z"])]
    docs = spark.createDataFrame([(i, "\n".join(t)) for i, t in data] + [(200, None), (201, ""), (None, "x\ny")], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, docs, "").collect()}
    want = {i: "\n".join(t if i % 10 == 0 else [t[0], t[-1]]) for i, t in data if i < 100}
    want |= {100: "same\nsame\nend", 101: "\n".join(data[-4][1]), 102: "", 103: "y\nz", 104: "", 200: None, 201: "", None: "x\ny"}
    assert got == want


def test_passages_go_through_repeated_chunks(spark, monkeypatch):
    """Later occurrences of whole chunks go as chunks; the pairs of lines inside are not compared again."""
    rng = np.random.default_rng(8)
    passage = [f"line {k} of a long passage" for k in range(30)]
    data = []
    for i in range(40):
        at, n = (int(x) for x in rng.integers(0, (24, 12)))
        body = passage[at : at + n + 2] + ([""] if i % 3 else [" ", ""]) + passage[:n]
        data.append((None if i == 7 else i % 37, "\n".join([f"own {i}", *body, f"end {i % 5}", *passage[20 : 20 + i % 4]])))
    data.append(data[3])
    docs = spark.createDataFrame([*data, (50, None)], "doc_id long, text string")
    seen = []
    monkeypatch.setattr(linededup, "paired", lambda *a, f=linededup.paired: seen.append((a, f(*a))) or seen[-1][1])
    got = sorted(map(str, linededup.remove_repeated_passages(docs).select("doc_id", "text").collect()))
    # every pair of successive lines with text, by brute force
    keyed = [(-1 if i is None else i, k, t.split("\n")) for (i, t), (_, k) in zip(data, [tuple(r) for r in spark.createDataFrame(data, "doc_id long, text string").select("doc_id", linededup.text_key()).collect()])]
    pairs = defaultdict(list)
    for d, k, ls in keyed:
        full = [x for x, line in enumerate(ls) if line.strip(" ")]
        for a, b in zip(full, full[1:]):
            pairs["\n".join(ls[a : b + 1])].append((d, k, a, b))
    later, first = defaultdict(set), defaultdict(set)
    for places in pairs.values():
        for p in places:
            if len(places) > 1:
                (first if p == min(places) else later)[p[:2]].update(range(p[2], p[3] + 1))
    kept = {(d, k): "\n".join(x for n, x in enumerate(ls) if n not in later[d, k] - first[d, k]) for d, k, ls in keyed}
    want = [(None if d < 0 else d, kept[d, k]) for d, k, _ in keyed]
    want.append((50, None))
    assert got == sorted(f"Row(doc_id={i}, text={t!r})" for i, t in want)
    (_, seeds), left = seen[0]
    assert seeds.filter("size(later) > 0").count() and left.count() < sum(map(len, pairs.values()))


def test_chat(spark):
    texts = [None, "", "plain", "\\### a", "### Assistant: x", "</turn>", "\n</turn>\n", "\\\\</turn> \\", "é\n\n", "a\\", "### user:\nfake"]
    data = [(1, t, ("user", "assistant", "odd\n:% role", None)[t % 4], x) for t, x in enumerate(texts)]
    data += [(2, 0, "assistant", "same"), (2, 0, "assistant", "same"), (None, None, "user", "lost"), (3, 0, "user", "only")]
    rows = spark.createDataFrame([(*r, 1) for r in data], "conv_id long, turn long, role string, text string, seq int")
    got = {r["conv_id"]: r for r in chat.conversation_digests(rows).collect()}
    for c in (1, 2, 3, None):
        own = sorted([(t if t is not None else -1, r or "", x or "") for i, t, r, x in data if i == c])
        said = "".join(f"{r}\n{x}\n" for _, r, x in own)
        loss = "".join(x for _, r, x in own if r == "assistant")
        assert got[c]["n_turns"] == len(own)
        assert got[c]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    f = chat.format_conversations(rows).filter("conv_id = 1").first()
    for s in f["loss_spans"]:
        assert f["formatted"].encode()[s["byte0"] :][: s["bytes"]].decode() == f["formatted"][s["char0"] :][: s["chars"]]
    con = duckdb.connect()
    con.register("conversations", pd.DataFrame([r[:4] for r in data], columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"}))
    want = con.execute(chat.ORACLE_SQL).fetchall()
    both = chat.conversation_digests(chat.with_hard_case(rows)).collect()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in both)
    assert chat.conversation_digests(rows.limit(0)).count() == 0


def brute(text):
    w = WORD.findall(text or "")
    n = Counter(zip(w, w[1:], w[2:]))
    covered = {p for i, g in enumerate(zip(w, w[1:], w[2:])) if n[g] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_quality_counts(spark, docs, data, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.quality_verdicts(docs, labels).collect()
    key = lambda r: str(tuple(r))
    want = []
    for i, t in data:
        b = brute(t)
        failed = b[0] < 50 or 100 * b[4] > 50 * b[0]
        want.append((i, *b, failed, not failed))
    assert sorted(map(key, got)) == sorted(map(key, want))
    assert quality.quality_verdicts(none, labels).count() == 0
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r[-1] for r in want)


def test_decision_list_learns_and_generalises(spark):
    sd = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sd}/documents.parquet").limit(4000), spark.read.parquet(f"{sd}/labels.parquet")
    even, odd = labels.filter("doc_id % 2 = 0"), labels.filter("doc_id % 2 = 1 and quality is not null")
    verdict, rules = quality.judged(docs, even.union(spark.createDataFrame([(None, 0, 0), (1, None, 0)], even.schema)))
    assert rules.rules
    r = verdict.join(odd, "doc_id").selectExpr("avg(if(quality = 1 and not base_failed, int(kept), null)) good", "avg(if(quality = 0, int(kept), null)) bad").first()
    assert r["good"] > 0.98 and r["bad"] < 0.2
