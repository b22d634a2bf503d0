"""Conversation repair, byte-level BPE and importance resampling against brute force and on defined edge cases."""

import hashlib
import heapq
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellscope.llm import byte_bpe, conversation_repair, importance_resampling, line_minhash, minhash_hamming

ODD = [(1, "alpha beta gamma delta epsilon zeta"), (1, "alpha beta gamma delta epsilon zeta"), (2, None), (3, ""), (None, "alpha beta"), (4, "x"), (5, "Word " * 60000), (6, "ÀÉ ß ñ\x00 ퟿")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "x", 7, 1, 0) for i, t in ODD], "doc_id long, text string, rank string, row int, score int, part int")


# ---------------------------------------------------------------- conversations

WHITE = " \t\n\x0b\x0c\r"


def damaged(rows):
    """Rows of one conversation (turn, role, text) after damage, in order."""
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text, code = " " if role is None else role, " " if text is None else text, zlib.crc32(key.encode()) % 20
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        role = "user" if code == 4 else role
        out += [(turn, role, text)] * (2 if code == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def cheapest(rows):
    """(cost, audit, lines) by trying edits in order of (cost, audit) until a whole conversation is read; rows are (role, text, fault)."""
    heap = [(0, "", 0, "", ())]  # cost, audit, rows read, initials so far, lines
    best = None
    while heap:
        cost, done, i, shape, lines = heapq.heappop(heap)
        if best and cost > best[0]:
            break
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", shape) and (best is None or (cost, done) < best[:2]):
            best = (cost, done, lines)

        def go(more, letter, at, symbol, line):
            if re.fullmatch("s?(ua)*u?", shape + symbol):
                heapq.heappush(heap, (cost + more, done + letter, at, shape + symbol, lines + line))

        if i < len(rows):
            role, text, fault = rows[i]
            late = fault == "truncated"
            go(3, "D", i + 1, "", ())
            if fault not in ("blank", "duplicate"):
                if role[:1] in ("s", "u", "a"):
                    go(late, "K", i + 1, role[:1], (f"{role}:{text}",))
                for new in ("user", "assistant"):
                    go(2 + late, "R", i + 1, new[0], (f"{new}:{text}",))
        if not done.endswith("III"):
            for new in ("user", "assistant"):
                go(2, "I", i, new[0], (f"{new}:",))
    return best


def expected(rows):
    rows = damaged(rows)
    seen, marked, n = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0, None: 0}
    for _, role, text in rows:
        last = text.rstrip(WHITE)[-1:]
        fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else None
        seen.add((role, text))
        n[fault] += 1
        marked.append((role, text, fault))
    turns = [t for t, _, _ in rows if t is not None]
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
    cost, audit, lines = cheapest(marked)
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def conversations(seed, n):
    rng, rows = random.Random(seed), []
    for conv in range(n):
        turns = sorted(rng.sample(range(9), rng.randrange(1, 6)))
        for turn in turns:
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "usher"])
            rows.append((conv, None if rng.random() < 0.08 else turn, role, rng.choice(["A.", "A.", "b", "C! ", " \t", None, "", "d? e"])))
    return rows + [(None, 1, "user", "q."), (None, 2, "assistant", "z"), (None, None, "assistant", "z")]


def test_repair_against_brute_force(spark, monkeypatch):
    rows = conversations(3, 250)
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, pos int, audit string")
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    groups = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    want = {k: expected(v) for k, v in groups.items()}
    monkeypatch.setattr(conversation_repair, "PER_TASK", 100)  # conversations are cut between tasks
    got = {r["conv_id"]: tuple(r[n] for n in names) for r in conversation_repair.repair_conversations(frame).collect()}
    assert got == want
    assert any(v[5] == 0 and v[6] == "" for v in want.values())  # a conversation without rows
    twice = conversation_repair.repair_conversations(frame.union(frame)).count()
    assert twice == len(groups) and conversation_repair.repair_conversations(frame.where("false")).count() == 0


def test_repair_blocks_chain():
    """Blocks parsed from every stack top and chained give what one parse gives."""
    rng = random.Random(5)
    for _ in range(300):
        rows = [(rng.choice("uuaast x").strip(), live := rng.random() < 0.8, live and rng.random() < 0.3, rng.randrange(0 if live else 1, 3)) for _ in range(rng.randrange(0, 14))]
        whole = {t: (n.cost, conversation_repair.audit(n)) for t, n in conversation_repair.parse(rows).items()}
        front, at = {0: (0, "")}, len(rows)
        while at > 0:
            start = max(0, at - rng.randrange(1, 5))
            front = conversation_repair.chain(front, [(o, t, n.cost, conversation_repair.audit(n)) for o in conversation_repair.STACKS
                                                      for t, n in conversation_repair.parse(rows[start:at], o).items()])
            at = start
        if rows:
            assert front == whole


def test_repair_long_conversation(spark):
    """One conversation of many rows, and a row that is repeated very often."""
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"t{t}.") for t in range(3000)] + [(2, 5, "user", "again.")] * 4000
    found = {r["conv_id"]: r for r in conversation_repair.repair_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    kept = damaged([r for r in rows if r[0] == 1])
    assert found[1]["audit"].count("K") + found[1]["audit"].count("D") + found[1]["audit"].count("R") == len(kept)
    assert found[2]["duplicate"] == len(damaged(rows[3000:])) - 1 and found[2]["audit"].count("D") >= found[2]["duplicate"]


# ---------------------------------------------------------------- byte-level BPE

def test_bpe_against_library(spark):
    tiktoken = pytest.importorskip("tiktoken")
    import public_tokenizers

    coder, rng = byte_bpe.codec(byte_bpe.VOCABULARY), random.Random(1)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    texts = ["", "a" * 3000, "aab" * 2000, "\t\n  x　 y  ", "it's I'LL 'll", "<|endoftext|>", "".join(chr(x) for x in range(0x110000) if not 0xD800 <= x < 0xE000)]
    for _ in range(200):
        texts.append("".join(chr(x) for x in (rng.randrange(0x110000) for _ in range(200)) if not 0xD800 <= x < 0xE000))
        texts.append("".join(rng.choice("ab c'stllve.\n\t 1２é漢") for _ in range(200)))
    for text, ids in zip(texts, coder.encode(texts)):
        assert ids.tolist() == library.encode_ordinary(text) and coder.decode(ids) == text.encode()
    sample = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r["doc_id"]: r for r in byte_bpe.digest_documents(sample).collect()}
    for doc_id, text in sample.select("doc_id", "text").collect():
        ids = library.encode_ordinary(text or "")
        listed = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert tuple(got[doc_id]) == (doc_id, len(ids), listed, hashlib.sha256((text or "").encode()).hexdigest())


def test_bpe_portions(monkeypatch):
    coder = byte_bpe.codec(byte_bpe.VOCABULARY)
    text = "Some words, it's 12 of  them\n and  more . . x " * 40
    whole = coder.encode([text])[0].tolist()
    monkeypatch.setattr(byte_bpe, "CHARS", 7)
    assert coder.encode([text])[0].tolist() == whole and len(list(coder.portions(text))) >= 40


def test_perfect_hash():
    keys = [str(i).encode() for i in range(5000)]
    found = byte_bpe.PerfectHash(keys)
    assert sorted(found(keys).tolist()) == list(range(5000)) and found([]).tolist() == []
    with pytest.raises(ValueError):
        byte_bpe.PerfectHash([b"a", b"a"])


def test_bpe_rows(spark, odd):
    rows = byte_bpe.digest_documents(odd).collect()
    assert len(rows) == len(ODD) and sum(r["n_tokens"] == 0 for r in rows) == 2
    assert byte_bpe.digest_documents(odd.where("false")).count() == 0
    encoded = byte_bpe.encode_documents(odd)
    back = sorted(((r["doc_id"] or 0), bytes(r["bytes"])) for r in byte_bpe.decode_documents(encoded).collect())
    assert back == sorted((i or 0, (t or "").encode()) for i, t in ODD)


# ---------------------------------------------------------------- importance resampling

def features(text):
    words = re.findall(rb"[0-9a-z\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    return words, words + [a + b" " + b for a, b in zip(words, words[1:])]


def resampled(docs, target, percent=25, least=20):
    s, t = np.zeros(10000, int), np.zeros(10000, int)
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for f in features(text)[1]:
                counts[zlib.crc32(f) % 10000] += 1
    gains = [math.floor(1000 * math.log((b + 1) * (s.sum() + 10000) / ((a + 1) * (t.sum() + 10000)))) for a, b in zip(s.tolist(), t.tolist())]
    rows = []
    for doc_id, text in docs:
        words, found = features(text)
        weight = sum(gains[zlib.crc32(f) % 10000] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words) >= least))
    order = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    k = len(order) * percent // 100
    drawn = [(*r[:4], n + 1) for n, r in enumerate(order[:k])] + [(*r[:4], None) for r in order[k:]] + [(*r[:4], None) for r in rows if not r[4]]
    return sorted(drawn, key=repr)


def test_resampling_against_brute_force(spark, monkeypatch):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    docs += [(9000, None), (9001, ""), (None, docs[0][1]), (9002, "x" * 70 + " Yes " + "é" * 40 + " no " * 30)]
    target = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    monkeypatch.setattr(importance_resampling, "PER_TASK", 20)  # winners are ranked over many tasks
    got = importance_resampling.resample(frame, spark.createDataFrame([(t,) for t in target], "text string"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == resampled(docs, target)


def test_resampling_selection(spark):
    keys = spark.range(5000).select(F.pmod(F.xxhash64("id"), F.lit(7)).alias("down"), F.lit(0).alias("absent"), F.lit(1).alias("id"), F.col("id").alias("row"))
    order = sorted(tuple(r) for r in keys.collect())
    for k in (1, 2, 777, 5000):
        assert tuple(importance_resampling.kth_key(keys, k, pivots=3)) == order[k - 1]


def test_resampling_portions(monkeypatch):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["a", "Bb", "é" * 20, "x" * 64, "y" * 65, "z" * 300, "-", "9"]) for _ in range(rng.randrange(0, 60))) for _ in range(100)] + ["", None]
    monkeypatch.setattr(importance_resampling, "CHUNK", 50)
    found, words = {}, {}
    for at, crc, single in importance_resampling._bucketed([importance_resampling.lower_bytes(t) for t in texts]):
        for a, c, one in zip(at.tolist(), crc.tolist(), single.tolist()):
            found.setdefault(a, []).append(c)
            words[a] = words.get(a, 0) + one
    for k, text in enumerate(texts):
        split, all_features = features(text)
        assert sorted(found.get(k, [])) == sorted(map(zlib.crc32, all_features)) and words.get(k, 0) == len(split)


def test_resampling_rows(spark, odd):
    none = odd.where("false")
    rows = importance_resampling.resample(odd, odd, least_words=1, percent=50).collect()
    assert len(rows) == len(ODD) and sorted(r["rank"] for r in rows if r["rank"]) == [1, 2, 3]
    assert importance_resampling.resample(none, odd).count() == 0
    assert importance_resampling.resample(odd, none).count() == len(ODD)


def test_line_dedup_with_clashing_names(spark):
    line = "The quick brown fox jumps over the lazy dog near the old river bank, and then it sleeps under a tree"
    docs = spark.createDataFrame([(1, line, "a", 5, 6, 7), (2, line, "b", 5, 6, 7)], "doc_id long, text string, gone string, n_lines int, gone_id int, id int")
    found = line_minhash.dedup_lines(docs)
    assert [(r["doc_id"], r["text"], r["gone"], r["gone_id"], r["id"], r["n_lines"], r["n_kept"]) for r in found.orderBy("doc_id").collect()] == [
        (1, line, "a", 6, 7, 1, 1), (2, "", "b", 6, 7, 1, 0)]


def test_line_windows_in_blocks(monkeypatch):
    rng = random.Random(9)
    lines = ["".join(rng.choice("abcé中\U0001f600") for _ in range(n)) for n in (40, 41, 700, 55, 1300, 60)]
    whole, least = line_minhash._distinct(lines), line_minhash._minima(lines)
    for i, line in enumerate(lines):
        n = len({line[k:k + line_minhash.SHINGLE] for k in range(len(line) - line_minhash.SHINGLE + 1)})
        assert (whole >> line_minhash.SET_BITS == i).sum() == n
        assert (line_minhash._minima([line])[0] == least[i]).all()
    monkeypatch.setattr(line_minhash, "BLOCK", 64)
    assert (line_minhash._distinct(lines) == whole).all() and (line_minhash._minima(lines) == least).all()


def test_keep_one_by_row(spark):
    long = "the quick brown fox jumps over the lazy dog near the old river bank and sleeps under a tall tree until the morning comes"
    other = "an entirely different text of several words that no one else in this small table has ever written down before today"
    rows = [(1, long, "a"), (2, long + " again", "b"), (2, other, "c"), (None, long, "d"), (None, "one two three four five six", "e"), (None, "one two three four five six", "e"),
            (3, None, "f"), (3, "", "g"), (4, "seven eight nine", "h"), (4, "seven eight nine", "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, mark string")
    kept = minhash_hamming.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["mark"] for r in kept.collect()) == ["a", "c", "e", "f", "g", "h"]
