"""Line dedup: few pairs of a crowded bucket are confirmed, and the join that picks them is compiled."""

from __future__ import annotations

import random
import re

from cellscope.llm import line_minhash


def _group(rng: random.Random, n: int) -> list[str]:
    """Lines with three of 55 words replaced in each, most of them near the threshold without reaching it."""
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9))
    base = [word() for _ in range(55)]
    lines = []
    for _ in range(n):
        words, i, j = base.copy(), rng.randrange(55), rng.randrange(54)
        words[i], words[j:j + 2] = word(), [word(), word()]
        lines.append(" ".join(words))
    return lines


def _components(lines: list[str]) -> dict[int, int]:
    sets = [{x[k:k + line_minhash.SHINGLE] for k in range(len(x) - line_minhash.SHINGLE + 1)} for x in lines]
    at = {i: i for i in range(len(lines))}
    for i in range(len(lines)):
        for j in range(i):
            if at[i] != at[j] and 100 * len(sets[i] & sets[j]) >= line_minhash.SIMILARITY * len(sets[i] | sets[j]):
                old, new = max(at[i], at[j]), min(at[i], at[j])
                at = {k: new if v == old else v for k, v in at.items()}
    return at


def test_few_pairs_of_a_crowded_bucket_are_confirmed(spark, monkeypatch):
    lines, tables = _group(random.Random(3), 80), {}
    plain = line_minhash.stored
    monkeypatch.setattr(line_minhash, "stored", lambda df, name: tables.setdefault(f"{name} {len(tables)}", plain(df, name)))
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    kept = {r["doc_id"] for r in line_minhash.dedup_lines(docs).where("n_kept = 1").collect()}
    assert kept == {k for k, v in _components(lines).items() if k == v} and 1 < len(kept) < len(lines)
    rest = sum(df.select("id").distinct().count() for name, df in tables.items() if name.startswith("line-rest "))
    across = sum(df.count() for name, df in tables.items() if name.startswith("line-across "))
    assert rest > 60 and across < 0.2 * rest * (rest - 1) / 2


def test_the_join_of_a_bucket_is_compiled(spark, capsys):
    about = spark.range(5).selectExpr("id", "id n", "id spare", *[f"id w{k}" for k in range(line_minhash.MAP_WORDS)], *[f"id e{k}" for k in range(line_minhash.MARK_WORDS)])
    rest = spark.range(5).selectExpr("id band", "id", "id comp", "id > 2 most")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        line_minhash._near(*(line_minhash.stored(x, "test") for x in (rest, rest, about))).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    found = capsys.readouterr().out
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", found)]
    assert "SortMergeJoin" in found and max(sizes) < 8000  # the JVM compiles no method of more than 8,000 bytes
