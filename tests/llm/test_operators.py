"""Corpus operators against brute force and on defined edge cases."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellscope.llm import decontaminate, deleted_interpolation, embedding_forest, html_template, line_minhash, minhash_hamming, pack_ffd, secrets_scan, shard_bfd, toxicity_knn
from cellscope.llm.components import connected_components

ODD = [(1, "alpha beta gamma delta epsilon zeta"), (1, "alpha beta gamma delta epsilon zeta"), (2, None), (3, ""), (None, "alpha beta gamma delta epsilon zeta"), (4, "x"), (5, "word " * 60000), (6, "ÀÉ ß ñ\x00 ퟿")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "x", 7) for i, t in ODD], "doc_id long, text string, component string, id int")


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1, 1), (5, 6), (6, 5)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        if a != b:
            a, b = sorted((root(a), root(b)))
            up[b] = a
    got = dict(map(tuple, connected_components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()))
    assert got == {x: root(x) for x in list(up)}


def test_secret_rules():
    text = 'api_key: "abc" token=token: sekret_9 AKIA' + "A" * 16 + " " + "0123456789abcdef" * 2 + " Zx9" + "qW3rT7yU1iO5pLk2"
    spans = secrets_scan.base_spans(text)
    assert [k for _, k, _ in spans] == [1, 2]  # the assign matches are too short, and what they span is consumed
    assert secrets_scan.known("d41d8cd98f00b204e9800998ecf8427e") and not secrets_scan.known("Zx9qW3rT7yU1iO5pLk2")


def test_secret_rows(spark, odd, none):
    rows = secrets_scan.scan_secrets(odd).collect()
    assert len(rows) == len(ODD) and all(r["base_sha256"] == hashlib.sha256(b"").hexdigest() for r in rows)
    assert secrets_scan.scan_secrets(none).count() == 0
    found = secrets_scan.scan_secrets(spark.createDataFrame([(1, "é key Zx9qW3rT7yU1iO5pLk2 here")], "doc_id long, text string")).first()
    assert found["spans"] == "random:6:25"


def _hits(text, items):
    words = decontaminate.words_of(text)
    hit, names = set(), set()
    for name, item in items:
        w = decontaminate.words_of(item)
        n = min(10, len(w))
        for i in range(max(0, len(w) - n + 1) if n else 0):
            for p in range(len(words) - n + 1):
                if words[p:p + n] == w[i:i + n]:
                    hit |= set(range(p, p + n))
                    names.add(str(name))
    return len(words), len(hit), ",".join(sorted(names))


@pytest.mark.parametrize("block", [16 << 20, 40])
def test_decontamination(spark, odd, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) for _ in range(40)]
    items = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(14)))) for i in range(8)] + [(50, None), (51, "")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items_sha256"], r["contaminated"]) for r in decontaminate.decontaminate(docs, bench).collect()}
    for i, t in enumerate(texts):
        n, hit, names = _hits(t, items)
        assert got[i] == (n, hit, hashlib.sha256(names.encode()).hexdigest(), hit > 0)
    clean = {r["doc_id"] for r in decontaminate.remove_contaminated(docs, bench).collect()}
    assert clean == {i for i in got if not got[i][3]}
    assert decontaminate.decontaminate(odd, bench).count() == len(ODD)
    assert decontaminate.decontaminate(odd, bench.where("false")).where("contaminated").count() == 0


def test_longest_match(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(1, "zero " + item + " end")], "doc_id long, text string")
    m = decontaminate.match_benchmark(docs, spark.createDataFrame([(9, item)], "item_id long, text string")).first()["matches"]
    assert [tuple(x) for x in m] == [("9", 1, 0, 12)]


def test_embedding_forest_recall(spark, monkeypatch):
    monkeypatch.setattr(embedding_forest, "LEAF", 64)
    monkeypatch.setattr(embedding_forest, "BLOCK", 32)
    rng = np.random.default_rng(3)
    base = rng.standard_normal((400, 16))
    near = base[rng.integers(0, 400, 400)] + rng.standard_normal((400, 16)) * 0.09
    x = np.concatenate([base, near, np.repeat(base[:1], 100, 0)])
    label = [int(k % 2) for k in range(len(x))]
    vectors = spark.createDataFrame([(k, v.tolist(), label[k]) for k, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r for r in embedding_forest.embedding_duplicates(vectors).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = (u @ u.T >= 0.98) & (np.array(label)[:, None] == np.array(label)[None, :])
    want = close.sum(1) - 1
    have = np.array([got[k]["n_links"] for k in range(len(x))])
    assert (have <= want).all() and have.sum() >= 0.9 * want.sum()


def test_embedding_odd_rows(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, None, 1), (5, [0.0, 0.0], 1), (6, [1.0, None], 1), (7, [float("nan"), 1.0], 1), (8, [1.0, 0.0], None), (9, [], 1), (None, [1.0, 0.0], 1), (10, [1.0, 0.0, 0.0], 1)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_forest.embedding_duplicates(vectors).collect()}
    assert got[1] == (2, 1, True) and got[2] == (2, 1, False) and got[None][0] == 2
    assert all(got[k] == (0, k, True) for k in (3, 4, 5, 6, 7, 8, 9, 10))
    assert embedding_forest.embedding_duplicates(vectors.where("false")).count() == 0


def _near_texts():
    rng = random.Random(4)
    texts = []
    for g in range(12):
        words = [f"w{g}x{k}" for k in range(80)]
        for _ in range(8):
            own = list(words)
            for _ in range(rng.randrange(5)):
                own[rng.randrange(80)] = f"z{rng.random()}"
            texts.append(" ".join(own))
    return texts + texts[:5]


def test_minhash_hamming(spark, odd, none):
    texts = _near_texts()
    sets = []
    for t in texts:
        w = t.lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)})
    comp = list(range(len(texts)))

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                comp[y] = x
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash_hamming.near_duplicates(docs).collect()}
    assert got == {k: (len(sets[k]), root(k), root(k) == k) for k in range(len(texts))}
    rows = [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash_hamming.near_duplicates(odd).collect()]
    assert len(rows) == len(ODD) and (2, 0, 2, True) in rows and (3, 0, 3, True) in rows and (4, 1, 4, True) in rows and (None, 2, 1, False) in rows
    assert minhash_hamming.near_duplicates(none).count() == 0
    assert minhash_hamming.keep_one(odd).columns == odd.columns


def test_index_guarantee():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 1 << 16, (200, minhash_hamming.VALUES)).astype(np.uint16)
    b = a.copy()
    for row in b:
        at = rng.choice(minhash_hamming.VALUES, minhash_hamming.MAX_DIFFERENT, replace=False)
        row[at] += 1
    x, y = minhash_hamming.index_keys(a), minhash_hamming.index_keys(b)
    assert all(set(p) & set(q) for p, q in zip(x.tolist(), y.tolist()))


PAGE = '<html><head><title>t</title><script>var a="</p>";</script></head><body><nav><ul><li><a href=x>Home</a></li></ul></nav><!-- ad --><div class="ad">Buy</div><article><h1>Head &amp; {0}</h1><p><b>First\n {0}.<br><p>Second &eacute; {1}</p></article><div id="comments"><p>Nice {0}</p></div><footer>&copy; me</footer>'


def test_html(spark):
    pages = [(k, f"http://h{k % 2}.example/{k}", PAGE.format(k, "word " * k)) for k in range(12)]
    odd_rows = [(90, None, None), (91, "odd", ""), (92, None, "plain text"), (None, "http://h0.example/x", PAGE.format(5, "q"))]
    df = spark.createDataFrame(pages + odd_rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    got = {r["page_id"]: r for r in html_template.extract_pages(df).collect()}
    for k in range(12):
        assert got[k]["text"] == "\n".join([f"Head & {k}", f"First {k}.", f"Second é {'word ' * k}".strip()])
        assert got[k]["n_chars"] == len(got[k]["text"])
    assert got[90]["text"] == "" and got[91]["text"] == "" and got[None]["text"].startswith("Head & 5") and len(got) == 16
    assert html_template.extract_pages(df.where("false")).count() == 0


def test_lm_counts_and_scores(spark, odd, none):
    rng = random.Random(6)
    rows = [(k, " ".join(rng.choice(["a b", "b a", "c d e", "A", "f" + str(rng.randrange(40))]) for _ in range(30))) for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in deleted_interpolation.score_documents(docs).collect()}
    taught = [t.lower().split() + [None] for i, t in rows if zlib.crc32(str(i).encode()) % 10]
    c = Counter(w for t in taught for w in t)
    n, v = sum(c.values()), len(c)
    for i, t in rows:
        words = t.lower().split() + [None]
        r = got[i]
        assert (r["n_tokens"], r["train_tokens"], r["n_known"]) == (len(words), n, sum(c[w] > 0 for w in words))
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words))
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert deleted_interpolation.score_documents(odd).count() == len(ODD) and deleted_interpolation.score_documents(none).count() == 0


def test_em_weights_sum_to_one():
    cells = np.array([[0, -1, 40, 5], [3, 8, 40, 50], [3, -1, 60, 10]], float)
    w = deleted_interpolation.fit_weights(cells, 1e-4)
    assert w.shape == (deleted_interpolation.BUCKETS, 3) and np.allclose(w.sum(1), 1) and w[3, 0] > w[3, 2] and w[0, 0] < 1e-9


def test_nearest_is_exact():
    rng = random.Random(7)
    rows = [({rng.randrange(30): rng.randrange(1, 4) for _ in range(rng.randrange(1, 6))}, rng.randrange(2)) for _ in range(300)]
    index = toxicity_knn.Index(rows, np.linspace(1, 3, 30), {0: 1.0, 1: 1.0}, list(range(300)))
    for c, _ in rows[:60]:
        q = index.vector(c)
        brute = sorted((sum(w * v.get(t, 0) for t, w in q.items()) for v, _, _ in index.rows), reverse=True)[:toxicity_knn.NEIGHBOURS]
        found = [s for s, _ in index.nearest(q)]
        assert found == pytest.approx([b for b in brute if b > 0], abs=1e-5)


def test_toxicity(spark, odd, none):
    rng = random.Random(8)
    docs = [(k, " ".join(f"w{rng.randrange(500)}" for _ in range(40)) + (" idiot moron" if k % 5 == 0 else "")) for k in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 5 == 0)) for k, _ in docs] + [(None, 1), (3, None)], "doc_id long, toxic int")
    rows = toxicity_knn.score_toxicity(df, labels).collect()
    assert all(r["predicted"] == int(r["doc_id"] % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    assert toxicity_knn.remove_toxic(df, labels).count() == 320
    assert toxicity_knn.score_toxicity(odd, labels).count() == len(ODD) and toxicity_knn.score_toxicity(none, labels).count() == 0
    assert toxicity_knn.score_toxicity(odd, labels.where("false")).where("score <> 0").count() == 0


def test_sharding(spark, odd, none):
    rng = random.Random(9)
    rows = [(k, "x" * rng.randrange(400) + str(rng.randrange(900))) for k in range(3000)] + [(k, "same") for k in range(50)]
    got = shard_bfd.assign_shards(spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
    assert len(got) == len(rows) and got["size"].sum() == sum(len(t) + 8 for _, t in rows)
    per = got.groupby("shard")["size"].sum()
    assert len(per) == 24 and per.max() - per.min() <= 0.02 * per.mean()
    assert all(sorted(g["slot"]) == list(range(len(g))) for _, g in got.groupby("shard"))
    assert got[got["text_crc32"] == zlib.crc32(b"same")]["shard"].nunique() == 1
    assert shard_bfd.assign_shards(odd).count() == len(ODD) and shard_bfd.assign_shards(none).count() == 0


def test_best_fit_decreasing():
    sizes = sorted((random.Random(10).randrange(1, 60) for _ in range(200)), reverse=True)
    room, place = [], []
    for s in sizes:
        fits = [(r, b) for b, r in enumerate(room) if r >= s]
        if fits:
            b = min(fits)[1]
        else:
            room.append(100)
            b = len(room) - 1
        room[b] -= s
        place.append(b)
    assert shard_bfd.best_fit_decreasing(sizes, 100) == place


def test_packing(spark, odd, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    plain.encode_special_tokens = True
    texts = ["It's 2 o'clock, ÀÉÎ straße!!", "", None, "naïve 한글 <|endoftext|> ½ é", "many words here " * 3000] + [f"text {k} " * k for k in range(60)]
    rows = pack_ffd.pack_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).toPandas()
    for i, t in enumerate(texts):
        ids = np.array(plain.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        mine = rows[rows["doc_id"] == i].sort_values("start")
        assert mine["length"].sum() == len(ids) == mine["doc_tokens"].iloc[0]
        for _, p in mine.iterrows():
            assert zlib.crc32(ids[p["start"]:p["start"] + p["length"]].tobytes()) == p["ids_crc32"]
    for _, s in rows.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s["offset"].tolist() == [0, *s["length"].cumsum().tolist()[:-1]] and s["length"].sum() <= 2048
    assert set(pack_ffd.pack_documents(odd).toPandas()["doc_id"].dropna()) == {1, 2, 3, 4, 5, 6} and pack_ffd.pack_documents(none).count() == 0


def test_first_fit_decreasing():
    lengths = np.array([random.Random(11).randrange(1, 2048) for _ in range(1)] + [random.Random(k).randrange(1, 2048) for k in range(300)])
    where, offset = pack_ffd.first_fit_decreasing(lengths)
    room, want = [], {}
    for i in np.argsort(-lengths, kind="stable"):
        b = next((k for k, r in enumerate(room) if r >= lengths[i]), None)
        if b is None:
            room.append(2048)
            b = len(room) - 1
        room[b] -= lengths[i]
        want[i] = b
    assert all(where[i] == b for i, b in want.items())


def test_line_dedup(spark, odd, none):
    line = "The quick brown fox jumps over the lazy dog near the old river bank, and then it sleeps under a tree for quite a while, as the people of the village walk past it and say very little until noon"
    near = line.replace("noon", "dusk")
    rows = [(1, f"{line}\nshort\nother words that stand in this one line only and nowhere else at all"), (2, f"{near}\nshort"), (3, line), (4, None), (5, "")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, gone string").withColumnRenamed("gone", "lang")
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_kept"]) for r in line_minhash.dedup_lines(df).collect()}
    assert got == {1: (rows[0][1], 3, 3), 2: ("short", 2, 1), 3: ("", 1, 0), 4: (None, 0, 0), 5: ("", 1, 1)}
    assert line_minhash.dedup_lines(odd).count() == len(ODD) and line_minhash.dedup_lines(none).count() == 0


def test_line_dedup_windows_at_every_position(spark):
    rng = random.Random(4)
    site = "https://www.example.com/"
    urls = [site + "articles/2024/the-history-of-the-old-mill-and-its-owners.html", site + "about/people-and-offices-in-the-northern-countries.html"]
    run = "".join(rng.choice("0123456789abcdef") for _ in range(160))
    han = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(80))
    astral = "".join(chr(rng.randrange(0x20000, 0x20400)) for _ in range(60))
    lines = [*urls, run, "zz" + run[2:], han, han[1:], han[::-1], astral, astral[2:], "see also the index", "see also the index", "see also", "see also"]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")

    def windows(s):
        return {s[i:i + line_minhash.SHINGLE] for i in range(len(s) - line_minhash.SHINGLE + 1)}

    def alike(a, b):
        if min(len(a), len(b)) < line_minhash.MIN_CHARS:
            return a == b and len(a.split()) >= line_minhash.SHORT_WORDS
        x, y = windows(a), windows(b)
        return 100 * len(x & y) >= line_minhash.SIMILARITY * len(x | y)

    gone = {j for j in range(len(lines)) for i in range(j) if alike(lines[i], lines[j])}
    assert gone == {3, 5, 8, 10}
    assert {r["doc_id"] for r in line_minhash.dedup_lines(docs).where("n_kept = 0").collect()} == gone


def test_toxicity_of_rare_words(spark):
    rows = [(k, f"calm weather over the harbour of town {k % 7} today") for k in range(400)]
    rows += [(1000 + k, f"vile insult number {k % 9} shouted at people") for k in range(400)]
    rows += [(2000 + k, "qorvat mezhul drasni pelgor") for k in range(6)]  # 6 of 406 toxic examples
    labels = [(i, int(i >= 1000)) for i, _ in rows]
    found = toxicity_knn.score_toxicity(spark.createDataFrame([*rows, (9000, "qorvat mezhul drasni pelgor")], "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    row = found.where("doc_id = 9000").first()
    assert row["score"] > 0.5 and row["evidence"].split(",")[0].split(":")[1:] == ["1.0000", "1"]


def test_secret_runs_are_all_measured(spark):
    lower, key, upper = "qzxvkjwpfhgtbnmlrcsd", "Zx9qW3rT7yU1iO5pLk2", "QZXVKJWPFHGTBNMLRCSD"
    path = "documentation/international/administration/information/government/"
    texts = [lower, upper, path + key, path + lower, "AKIA" + "A1B2" * 5 + "-" + lower, path, "internationalization-administration",
             "d41d8cd98f00b204E9800998ecf8427e", "123e4567-e89b-12d3-a456-426614174000", "2024-01-02/10-20-30-4567", "-" * 60]
    found = secrets_scan.scan_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    spans = {r["doc_id"]: [x for x in r["spans"].split(",") if x.startswith("random")] for r in found}
    n = len(path)
    assert spans[0] == spans[1] == ["random:0:20"] and spans[2] == [f"random:{n}:{n + len(key)}"] and spans[3] == [f"random:{n}:{n + len(lower)}"]
    assert len(spans[4]) == 1 and spans[4][0].endswith(":45")
    assert not any(spans[k] for k in range(5, len(texts)))
