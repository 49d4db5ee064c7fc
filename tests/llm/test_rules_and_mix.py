"""Quality rules, mixing, URL rules, resharding."""

import hashlib
import random
import re
import zlib

import duckdb
import pytest

from matchlake.llm import mixing, quality_rules, resharding, url_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TESTDATA = "/root/testdata/sf0.001"


def brute_rules(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    wins = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(wins) if wins.count(w) > 1 for k in range(5)} if len(wins) < 2000 else None
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            None if covered is None else len(covered))


def test_rules_against_brute_force(make_docs, hostile):
    got = quality_rules.judge(make_docs(hostile)).collect()
    assert len(got) == len(hostile)
    want = sorted(str((i, *brute_rules(t)[:4])) for i, t, _ in hostile)
    assert sorted(str((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines)) for r in got) == want
    by_id = {i: t for i, t, _ in hostile if i is not None}
    for r in got:
        if r.doc_id is not None and (repeats := brute_rules(by_id[r.doc_id])[4]) is not None:
            assert r.n_repeat_words == repeats
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)


def test_frequent_lines_go_copies_stay(make_docs):
    rng = random.Random(1)

    def line(n=12):
        return " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))

    ours, copied = "Click HERE for 12 offers", "\n".join(line() for _ in range(4))
    rows = [(k, f"{line()}\n  click here  for 97 offers\n{line()}", "h") for k in range(60)]
    rows += [(100 + k, copied + f"\n{line()}", "h") for k in range(200)]
    rows += [(400, "\n".join([ours] * 9 + [line(3)]), "h"), (401, f"{ours}\n{line()}", "other")]
    docs = make_docs(rows)
    judged = {r.doc_id: r for r in quality_rules.judge(docs, max_repeat_pct=1000).collect()}
    assert all(judged[k].kept and judged[k].removed_words == 5 for k in range(60))
    assert all(judged[100 + k].kept and judged[100 + k].removed_words == 0 for k in range(200))
    assert not judged[400].kept and judged[401].removed_words == 0
    out = quality_rules.clean(docs, length_col="n_chars", max_repeat_pct=1000)
    assert out.columns == docs.columns
    texts = {r.doc_id: r for r in out.collect()}
    assert 400 not in texts and "here" not in texts[3].text and texts[3].n_chars == len(texts[3].text)
    assert texts[150].text == dict((i, t) for i, t, _ in rows)[150]


def lines_of(rng, n, words=12):
    return [" ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(words)) for _ in range(n)]


@pytest.mark.parametrize("shared,own", [(2, 3), (3, 3), (5, 4), (3, 1)])
def test_blocks_of_frequent_lines_go_whole(make_docs, shared, own):
    rng = random.Random(shared * 10 + own)
    block = lines_of(rng, shared)
    rows = [(k, "\n".join(block + lines_of(rng, own)), "h") for k in range(70)]
    rows += [(200 + k, "\n".join(block), "h") for k in range(5)]
    judged = quality_rules.judge(make_docs(rows)).collect()
    assert all(r.removed_words == 12 * shared for r in judged)
    assert all(r.kept == (r.doc_id < 200 and own >= 0.3 * (shared + own)) for r in judged)


def brute_kept(rows, min_docs=50):
    """Verdicts by rows, from sets of distinct documents."""

    def key(line):
        return re.sub(r"[\x20\x09-\x0D]+", " ", re.sub("[0-9]", "0", line.lower().strip(" \t\n\x0b\x0c\r")))

    def lines(text):
        return [(key(x), len(WORD.findall(x))) for x in (text or "").split("\n") if WORD.search(x)]

    texts, documents = {}, {}
    for _, text, host in rows:
        for k, _ in lines(text):
            texts.setdefault((host, k), set()).add(text)
    shared = {k for k, v in texts.items() if len(v) >= min_docs}
    for _, text, host in rows:
        held = {(k, n) for k, n in lines(text) if (host, k) in shared}
        own = sum(n for _, n in set(lines(text)) - held)
        total = sum(n for _, n in set(lines(text)))
        first = min((k for k, _ in held), key=lambda k: hashlib.md5(k.encode()).hexdigest(), default=None)
        for k, _ in held:
            documents.setdefault((host, k), set()).add(("text", text) if own > 0.2 * total else ("line", first))
    frequent = {k for k, v in documents.items() if len(v) >= min_docs}
    out = []
    for i, text, host in rows:
        n, _, _, _, repeats = brute_rules(text)
        gone = sum(w for k, w in lines(text) if (host, k) in frequent)
        out.append((i, gone, n >= 10 and 100 * repeats <= 20 * n and n - gone >= 0.3 * n))
    return out


def test_verdicts_against_brute_force(make_docs):
    rng = random.Random(4)
    pool, rows = lines_of(rng, 6), []
    template = lines_of(rng, 12)
    for k in range(400):
        host = rng.choice(["h", "h", "h", None, "small"])
        held = rng.sample(pool, rng.randrange(0, 5))
        rows.append((k, "\n".join(held + lines_of(rng, rng.randrange(0, 4))), host))
    for k in range(300):  # Near copies: one line of twelve is changed.
        copy = list(template)
        copy[rng.randrange(12)] = lines_of(rng, 1)[0]
        rows.append((1000 + k, "\n".join(copy), "h"))
    rows += [(2000, None, "h"), (2001, "", None), (2002, rows[0][1], rows[0][2])]
    rows += [(2003, pool[0], "h")] * 60
    want = brute_kept(rows)
    got = [(r.doc_id, r.removed_words, r.kept) for r in quality_rules.judge(make_docs(rows)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert all(kept and not gone for i, gone, kept in want if 1000 <= i < 2000)
    assert any(gone for _, gone, _ in want)


def test_one_probe_for_each_key(spark, monkeypatch):
    pages = [(k, f"https://site{k % 400}.com/") for k in range(1200)] + [(5000, "http://a.net/es/x"), (5001, None)]
    seen = []
    sort = url_rules.smallest
    monkeypatch.setattr(url_rules, "smallest", lambda df, *a: seen.append(df.collect()) or sort(df, *a))
    rules = spark.createDataFrame(url_rules.RULES, "host string, path string, verdict string")
    pages = spark.createDataFrame(pages, "page_id long, url string")
    got = {r.page_id: r for r in url_rules.judge(pages, rules, default="none").collect()}
    assert all(got[k].rule == "com/" and got[k].verdict == "allow" for k in range(1200))
    assert (got[5000].rule, got[5000].verdict, got[5001].verdict) == ("net/es/", "block", "none")
    keys = [r["key"] for r in seen[0]]
    assert len(keys) == len(set(keys)) and keys.count("com//") == 1


@pytest.mark.parametrize("module,table", [(quality_rules, "documents"), (url_rules, "pages")])
def test_sql(spark, module, table):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TESTDATA}/{table}.parquet'")
    want = con.execute(module.SQL)
    names = [c[0] for c in want.description]
    got = module.query(spark, TESTDATA).select(*names).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want.fetchall()))


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    left, free, out = 1.5 * sum(sizes.values()), set(order), {}
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if 2 * sizes[s] <= level * weight[s]}
        if not full:
            return out | {s: level * weight[s] for s in free}
        for s in full:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        free -= full
    return out


def mixed(docs):
    rows, limits = mixing.plan(docs)
    joined = mixing.join_rows(rows, limits, ["source"])
    return joined.withColumn("taken", mixing.taken_copies() * joined["size"]).collect()


def test_mix(make_docs, hostile):
    rng = random.Random(3)
    more = [(1000 + k, " ".join(["w"] * rng.randrange(1, 40)), rng.choice(["a", "b", "b", "b", "s1", None])) for k in range(900)]
    docs = make_docs(hostile + more)
    got = mixed(docs)
    sizes = {}
    for _, t, s in hostile + more:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    want = brute_targets(sizes)
    taken = {}
    for r in got:
        assert r["size"] * 2 >= r.taken >= 0 and r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        taken[r.source] = taken.get(r.source, 0) + r.taken
    largest = {s: max(len(WORD.findall(t or "")) for _, t, x in hostile + more if x == s) for s in sizes}
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in sizes)
    assert sorted(map(str, got)) == sorted(map(str, mixed(docs)))
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    assert out.count() == sum(round(r.taken / r["size"]) for r in got if r["size"])


def test_smaller_mix_is_part_of_larger(make_docs, hostile):
    docs = make_docs(hostile)
    small, large = (
        {r.doc_id for r in mixing.mix(docs, share=s).select("doc_id").collect()} for s in (0.4, 0.8)
    )
    assert small <= large


def test_urls_against_brute_force(spark):
    rng = random.Random(3)

    def host():
        return ".".join(rng.choice(["a", "b", "", "c"]) for _ in range(rng.randint(1, 4)))

    def path():
        return "/" + "".join(rng.choice("xy/") for _ in range(rng.randint(0, 4))) if rng.random() < 0.9 else ""

    rules = [(host(), path(), rng.choice(["allow", "block"])) for _ in range(50)] + [(None, "/", "block")]
    urls = [(i, f"http://{host()}{path()}?q") for i in range(300)]
    urls += [(None, None), (7, "nope"), (8, "HTTP://A.b#x"), (9, ""), (9, ""), (10, "x://" + "a." * 300 + "b/x")]
    pages = spark.createDataFrame([(*u, "k", "v") for u in urls], "page_id long, url string, key string, verdict string")
    rules_df = spark.createDataFrame(rules, "host string, path string, verdict string")
    best = {}
    for h, p, v in rules[:-1]:
        best[h, p] = max(v, best.get((h, p), ""))
    got = url_rules.judge(pages, rules_df, parts=5).collect()
    assert len(got) == len(urls)
    for r in got:
        fits = [(len(h + p), len(h), h + p, v) for (h, p), v in best.items()
                if (r.host == h or r.host.endswith("." + h)) and r.path.startswith(p)]
        assert (r["rule"], r.verdict) == (max(fits)[2:] if fits else (None, "allow"))
    assert url_rules.judge(pages.limit(0), rules_df.limit(0)).count() == 0
    assert {r.verdict for r in url_rules.judge(pages, rules_df.limit(0), default="block").collect()} == {"block"}


def test_flow_moves_least():
    rng = random.Random(2)
    for _ in range(30):
        supply = [rng.randrange(20) for _ in range(rng.randint(1, 5))]
        demand = resharding.even(sum(supply), rng.randint(1, 7))
        flows = resharding.minimum_cost_flow(supply, demand)
        assert [sum(f for (i, _), f in flows.items() if i == k) for k in range(len(supply))] == supply
        assert [sum(f for (_, j), f in flows.items() if j == k) for k in range(len(demand))] == demand
        stay = sum(min(a, b) for a, b in zip(supply, demand, strict=False))
        assert sum(f for (i, j), f in flows.items() if i == j) == stay


def test_reshard_round_trip(make_docs, hostile):
    docs = make_docs(hostile)
    got = resharding.reshard(docs, new_shards=5).collect()
    want = sorted((str(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in hostile)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == want
    for shard in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert resharding.reshard(docs.limit(0)).count() == 0


def test_rewrite_affected_only(spark, make_docs, hostile, tmp_path):
    docs = make_docs(hostile)
    moves = resharding.plan(docs, new_shards=17)
    touched = resharding.affected(moves, resharding.OLD_SHARDS)
    assert 16 in touched
    resharding.rewrite(docs, moves, str(tmp_path / "out"), shards=sorted(touched))
    written = spark.read.parquet(str(tmp_path / "out"))
    assert {r[0] for r in written.select("_shard").distinct().collect()} <= touched
    assert set(docs.columns) <= set(written.columns)


def test_even_shards(spark):
    docs = spark.read.parquet(f"{TESTDATA}/../sf0.01/documents.parquet")
    sums = resharding.reshard(docs).groupBy("shard").sum("size").collect()
    sizes = [r[1] for r in sums]
    assert len(sizes) == 24 and max(sizes) < 1.02 * min(sizes)


def test_empty_tables(make_docs):
    empty = make_docs([(1, "a", "s")]).limit(0)
    assert quality_rules.judge(empty).count() == 0
    assert mixing.mix(empty).count() == 0
