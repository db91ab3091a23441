"""The training-data operators against brute force, round trips, held-out labels and odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from pagefacts import session
from pagefacts.llm import hamming, interpolation, mixing, packing, pii, quality, superminhash, token_counts, toxicity, urls

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, copies int"
LONG = "word " * 30_000 + "end"
ODD = [
    (1, None, None, None, None, None, None, None),
    (2, "", "en", "a", 0, 0.5, True, 1),
    (3, "one two three four five six", "en", "a", 27, None, None, 2),
    (3, "one two three four five six", "en", "a", 27, None, None, 2),
    (None, "one two three four five six", "en", None, 27, None, None, 2),
    (5, LONG, None, "b", len(LONG), None, None, 3),
    (6, "mail a.b@c.example.com, +1 (269) 555-3296, 67.190.110.215 <|endoftext|>  two", "de", "b", 60, None, None, 3),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_token_counts_match_the_library(odd, docs):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    for df in (odd, docs):
        got = Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(df, path).collect())
        want = Counter()
        for r in df.select("doc_id", "text").collect():
            n = len(library.encode(r.text or "", add_special_tokens=False).ids)
            want[r.doc_id, len((r.text or "").encode()), n, n > 512] += 1
        assert got == want


def test_packing_places_each_id_once_without_padding(odd, docs):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rows = packing.pack_documents(docs, path).collect()
    ids = {r.doc_id: library.encode(r.text or "", add_special_tokens=False).ids + [2] for r in docs.collect()}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(ids)
    for d, parts in by_doc.items():
        at = 0
        for r in sorted(parts, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids[d])
            at += r.length
            assert r.ids_crc32 == zlib.crc32(np.array(ids[d][r.start : at], "<u4").tobytes())
        assert at == len(ids[d])
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096 and at & (at - 1) == 0
    pieces = packing.pack_documents(odd, path).collect()
    assert sum(r.length for r in pieces if r.doc_id in (1, 2)) == 2
    assert Counter(r.doc_id for r in pieces if r.start == 0) == Counter(r[0] for r in ODD)
    assert packing.pack_documents(odd.limit(0), path).collect() == []


def test_step_groups_hold_equal_tokens_over_tasks(spark, docs):
    rows = packing.pack_documents(docs.repartition(8), public_tokenizers.path("word_bpe_49k.json"), step_tokens=1 << 14).collect()
    tokens, of = Counter(), {}
    for r in rows:
        tokens[r.tier, r.step_group] += r.length
        assert of.setdefault(r.sequence_id, r.step_group) == r.step_group
    for tier in {t for t, _ in tokens}:
        groups = sorted(g for t, g in tokens if t == tier)
        assert groups == list(range(groups[0], groups[0] + len(groups)))
        assert all(tokens[tier, g] == 1 << 14 for g in groups[:-1]) and tokens[tier, groups[-1]] <= 1 << 14
    assert len({g for _, g in tokens}) == len(tokens) and sum(1 for t, _ in tokens if t == 4096) > 3


def test_toxicity_restores_and_ranks(spark, odd, docs, sf_dir):
    model = toxicity.trained(spark, docs, sf_dir)
    chars = toxicity.CharModel(Counter(g for w in ["idiot", "stupid", "the", "and", "hello"] * 50 for g in toxicity.trigrams(w)))
    assert toxicity.restored_word("1d10t", chars) == "idiot"
    assert toxicity.restored_word("i.d.i.o.t", chars) == "idiot"
    assert toxicity.key_of(toxicity.restored_word("stuuuupid!", chars)) == "stupid"
    assert toxicity.restore_text("the i d i o t", chars) == "the idiot"
    assert toxicity.restore_text(None, chars) == ""
    for r in toxicity.score_toxicity(odd, model).collect():
        assert 0 <= r.score <= 1
    assert toxicity.fit(docs.limit(0), spark.createDataFrame([], "doc_id long, toxic int")).lexicon.weights == {}


def test_toxicity_finds_borders_in_spaced_and_long_runs(spark):
    known = "you are a an i the stupid man idiot and is bad this what it in to of".split()
    chars = toxicity.CharModel(Counter(g for w in known * 50 for g in toxicity.trigrams(w)), dict.fromkeys(known, 50))
    for written, want in [
        ("you are a s t u p i d man", "you are a stupid man"), ("i s t u p i d", "i stupid"), ("y o u a r e a n i d i o t", "you are an idiot"),
        ("s t u p i d i d i o t", "stupid idiot"), ("a  s t u p i d  m a n", "a stupid man"), ("so b a d", "so bad"), ('"s t u p i d".', '"stupid".'),
        ("y o u a r e a n i d i o t " * 9, "you are an idiot " * 9), ("y-o-u-" * 15 + "1d10t", None),
    ]:
        got = toxicity.restore_text(written, chars)
        if want is None:
            assert got.endswith("idiot")
        else:
            assert [w.strip('".') for w in got.split()] == [w.strip('".') for w in want.split()], got
    docs = spark.createDataFrame([(1, "abcd abcd"), (2, "efgh")], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(1, 0)], "doc_id long, toxic int"))
    assert model.chars.tri["efg"] == 1 and model.chars.tri["abc"] == 2


def test_toxicity_learns_planted_words(spark):
    rows = [(i, ("plain text here number %d " % (i % 7)) * 5 + ("such an idiot" if i % 3 == 0 else "such a day")) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = df.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    model = toxicity.fit(df, labels)
    hard = spark.createDataFrame([(1, "you are an 1d10t"), (2, "you have a day"), (3, "an i d i o t")], "doc_id long, text string")
    got = {r.doc_id: r.score >= 0.3 for r in toxicity.score_toxicity(hard, model).collect()}
    assert got == {1: True, 2: False, 3: True}


def test_url_rules_and_parts(spark):
    rows = [
        (1, "https://A.Example.ORG/es/x?q#f"), (2, "http://example.org/en/12"), (3, "http://x.org"), (4, "http://z.com/fr/1#a"),
        (5, "http://z.com/de/1"), (6, None), (7, "no scheme"), (8, "http://z.net/a"), (8, "http://z.net/a"), (9, "x://?a://b/"),
    ]
    got = urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string").withColumn("rule", F.lit(1))).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == 10 and {r.verdict for r in got} <= {"allow", "block"}
    assert (by[1].host, by[1].path, by[1].rule, by[1].verdict) == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert by[2].rule == "example.org/en/1" and by[3].rule is None and by[3].path == ""
    assert (by[4].rule, by[5].rule) == ("com/fr/", "com/de/")
    assert (by[6].host, by[6].path, by[7].host, by[9].host) == ("", "", "", "")


def test_url_model_reads_whole_addresses_and_equals_brute_force(spark):
    labelled = [f"http://h{i}.example.org/{'es' if i % 2 else 'page'}/{i}?to={'bad' if i % 2 else 'good'}{i % 7}" for i in range(60)]
    asked = ["http://x.net/a?to=bad3", "http://x.net/a?to=good3", "http://x.net/a#good", "good text", "bad text", None, "", "ftp://U@X.net:80/p", "http://x.net/" + "bad/" * 3000]
    rows = list(enumerate(labelled + asked))
    got = {r.page_id: r for r in urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()}

    def address(u):
        if u is None or "://" not in u:
            return u or ""
        rest = u.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        return host.encode().lower().decode() + rest[len(host):]

    def grams(text):
        padded = urls.START * (urls.ORDER - 1) + text + urls.END
        return [padded[i : i + urls.ORDER] for i in range(len(padded) - urls.ORDER + 1)]

    counts = {v: Counter() for v in ("allow", "block")}
    for i, u in rows:
        label = got[i].verdict if got[i].rule else None
        if label and zlib.crc32(address(u).encode()) % urls.FOLDS:
            counts[label].update(grams(address(u)))

    def probability(label, gram):
        p = 1 / urls.ALPHABET
        for n in range(1, urls.ORDER + 1):
            end = gram[-n:]
            followers = Counter()
            for g, c in counts[label].items():
                if g[-n:][:-1] == end[:-1]:
                    followers[g[-1]] += c
            total, kinds = sum(followers.values()), len(followers)
            p = (followers[gram[-1]] + kinds * p) / (total + kinds) if total else p
        return p

    for i, u in rows[len(labelled) : -1]:
        found = [math.log(probability("allow", g)) - math.log(probability("block", g)) for g in grams(address(u))]
        assert abs(got[i].difference - sum(found) / len(found)) < 1e-9, u
    assert got[61].difference > got[60].difference and got[63].difference > got[64].difference
    assert urls.filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_url_model_sums_to_one_and_separates(spark, sf_dir):
    # Of whole addresses the smallest tables label 19 only, too few to learn queries from.
    pages = spark.read.parquet(f"{sf_dir}/../sf0.01/pages.parquet")
    rows = urls.filter_urls(pages.select("page_id", "url")).filter("rule is not null").collect()
    right = sum((r.difference > 0) == (r.verdict == "allow") for r in rows)
    assert right >= 0.9 * len(rows)
    assert "Python" not in urls.filter_urls(pages)._jdf.queryExecution().executedPlan().toString()


def brute_groups(sets, percent):
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_near_duplicates_match_brute_force(docs):
    texts = {r.doc_id: r.text for r in docs.collect()}

    def shingles(text, n=3):
        w = words((text or "").encode().lower().decode())
        return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()

    sets = {i: shingles(t) for i, t in texts.items()}
    want = brute_groups(sets, 85)
    got = superminhash.near_duplicates(docs, width=3, threshold=0.85).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.n_shingles == len(sets[r.doc_id]) and r.kept == (r.doc_id == r.component_id) for r in got)


def test_crossing_leaves_out_no_pair_that_reaches_the_threshold(spark):
    rng = np.random.default_rng(8)
    base = [f"b{i}" for i in range(60)]
    texts = []
    for i in range(90):  # copies just above and just below the threshold, of three bases
        w = [f"{'xyz'[i % 3]}{x}" if i % 3 else x for x in base]
        for k in rng.choice(60, rng.integers(0, 5), replace=False):
            w[k] = f"new{rng.integers(0, 40)}"
        texts.append(" ".join(w[: rng.integers(50, 61)]))
    texts += ["one", "one", "one two", ""]
    nodes = spark.createDataFrame([(i, i % 17) for i in range(len(texts))], "node long, component long")
    rows = spark.createDataFrame([(i, t.encode()) for i, t in enumerate(texts)], "node long, _data binary")
    sets = [set(x.tolist()) for x in superminhash.sets_of([t.encode() for t in texts], 3)]
    want = {
        (a, b) for b in range(len(sets)) for a in range(b)
        if a % 17 != b % 17 and sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    }
    got = [tuple(r) for r in superminhash.crossing(nodes, rows, 0.85, 3).collect()]
    assert len(got) == len(set(got)) and want <= set(got) and len(want) > 20
    assert len(got) < sum(a % 17 != b % 17 for b in range(len(sets)) for a in range(b)) / 2


def test_near_duplicates_of_odd_rows(spark, odd):
    got = Counter((r.doc_id, r.component_id, r.kept) for r in superminhash.near_duplicates(odd).collect())
    assert got[3, 3, True] == 2 and got[None, 3, False] == 1 and got[2, 2, True] == 1 and got[1, 1, True] == 1
    assert superminhash.near_duplicates(odd.limit(0)).count() == 0


def test_one_row_of_each_group_stays_whatever_the_ids(spark):
    rng = np.random.default_rng(12)
    rows = []
    for group in range(25):
        base = [f"g{group}w{i}" for i in range(60)]
        for copy in range(rng.integers(1, 6)):
            w = list(base)
            if copy % 2:
                w[rng.integers(0, 60)] = f"new{rng.integers(0, 1000)}"
            # A third of the rows have no id, others share one across groups.
            rows.append((None if rng.random() < 0.34 else int(rng.integers(0, 12)), " ".join(w), f"g{group}"))
    rows += [rows[0], rows[0], (None, rows[1][1], "g0"), (None, "", None), (None, None, None), (3, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = superminhash.near_duplicates(docs, keep=(F.col("source"), F.col("text"))).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r[0], r[1]) for r in rows)
    texts = [r.text for r in got]
    sets = {i: set(x.tolist()) for i, x in enumerate(superminhash.sets_of([(t or "").encode() for t in texts], 5))}
    groups = brute_groups(sets, 80)
    for g in set(groups.values()):
        members = [got[i] for i in groups if groups[i] == g]
        ids = [r.doc_id for r in members if r.doc_id is not None]
        if members[0].text:
            assert {r.component_id for r in members} == {min(ids, default=None)}
            stay = [r for r in members if r.stays]
            assert len(stay) == 1 and stay[0].doc_id == min(ids, default=None)
        else:
            assert all(r.stays for r in members)
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs.selectExpr("*", "'en' AS lang", "1L AS n_chars"), None).collect()
    texts_left = Counter(r.text for r in stage)
    assert all(sum(texts_left[t] for t in {got[i].text for i in groups if groups[i] == g}) == 1 for g in set(groups.values()) if got[g].text)


def test_near_duplicates_leave_no_dead_tables(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path))
    superminhash.near_duplicates(docs).count()
    assert {p.name.split("-")[0] for p in tmp_path.iterdir()} == {"signed", "groups"}


def test_building_queries_leaves_the_settings_alone(spark, sf_dir):
    configured = entry.configure(spark)
    before = dict(configured.sparkContext.getConf().getAll()), {k: spark.conf.get(k) for k in session.SETTINGS}
    for name in ("op3_packing", "op7_mixing", "op9_token_counts", "op11_fill_in_middle", "op12_filter_audit", "op13_licenses", "page_gate"):
        entry.queries()[name](spark, sf_dir)
    assert before == (dict(spark.sparkContext.getConf().getAll()), {k: spark.conf.get(k) for k in session.SETTINGS})


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(3)
    errors = []
    for _ in range(30):
        both, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (300, 60, 40))
        x, y = superminhash.signature(np.unique(np.append(both, a))), superminhash.signature(np.unique(np.append(both, b)))
        errors.append((x == y).mean() - 0.75)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.04


def test_interpolation_base_and_gain(odd, docs):
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 1
    got = {r.doc_id: r for r in interpolation.score_texts(docs, held).collect()}
    counts = Counter()
    texts = {r.doc_id: words((r.text or "").encode().lower().decode()) + [None] for r in docs.collect()}
    for i, w in texts.items():
        if zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update(w)
    n, v = sum(counts.values()), len(counts)
    for i, w in texts.items():
        base = sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        assert got[i].train_tokens == n and got[i].n_tokens == len(w) and got[i].n_known == sum(counts[x] > 0 for x in w)
        assert abs(got[i].base_score - base) < 1e-6 * max(1, abs(base))
    out = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    assert interpolation.score_texts(odd, held).count() == len(ODD)


def test_hamming_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    bits = rng.integers(0, 2, (400, 24)).tolist()
    bits[100:160] = [bits[0]] * 60
    rows = [(i, b) for i, b in enumerate(bits)] + [(None, bits[1]), (401, None), (402, [])]
    codes = spark.createDataFrame(rows, "id long, bits array<int>")
    queries = codes.filter("id % 50 = 0").withColumnRenamed("id", "query_id")
    got = {(r.query_id, r.rank): (r.id, r.distance) for r in hamming.top_k(codes, queries, 7).collect()}
    for q in range(0, 400, 50):
        near = sorted((sum(x != y for x, y in zip(bits[q], b)), i if i is not None else 10**9, i) for i, b in rows[:401])[:7]
        assert [got[q, k + 1] for k in range(7)] == [(i, d) for d, _, i in near]
    assert hamming.top_k(codes.limit(0), queries, 7).count() == 0


def test_hamming_of_several_lengths_and_hot_segments(spark, monkeypatch):
    monkeypatch.setattr(hamming, "BLOCK_ROWS", 32)
    rng = np.random.default_rng(6)
    # A third of the codes share their first 20 bits; others are of another length, or far from all.
    rows = [(i, ([0, 1] * 10 if i % 3 == 0 else rng.integers(0, 2, 20).tolist()) + rng.integers(0, 2, 28).tolist()) for i in range(900)]
    rows += [(2000 + i, rng.integers(0, 2, 11).tolist()) for i in range(60)] + [(3000, [1] * 5), (3050, [0, 1, 1, 0, 1])]
    codes = spark.createDataFrame(rows, "id long, bits array<int>")
    queries = codes.filter("id % 50 = 0").withColumnRenamed("id", "query_id")
    got = {}
    for r in hamming.top_k(codes, queries, 9).collect():
        got.setdefault(r.query_id, []).append((r.distance, r.id, r["rank"]))
    for q, bits in rows:
        if q % 50 == 0:
            near = sorted((sum(x != y for x, y in zip(bits, b)), i) for i, b in rows if len(b) == len(bits))[:9]
            assert sorted(got.pop(q)) == [(d, i, k + 1) for k, (d, i) in enumerate(near)]
    assert not got


def test_hamming_queries_meet_no_more_blocks_in_more_codes(spark, monkeypatch):
    plain, met = hamming.hits, []

    def counted(probes, blocks, k):
        met.append(probes.join(blocks, ["dim", "part", "high"]).count())
        return plain(probes, blocks, k)

    monkeypatch.setattr(hamming, "hits", counted)
    total = {}
    for n in (2000, 10000):
        bits = np.random.default_rng(7).integers(0, 2, (n, 64)).tolist()
        codes = spark.createDataFrame(list(enumerate(bits)), "id long, bits array<int>").cache()
        hamming.top_k(codes, codes.filter("id % 100 = 0").withColumnRenamed("id", "query_id"))
        total[n], met[:] = sum(met), []
    assert total[10000] < 8 * total[2000]


def test_hamming_compares_fewer_codes_than_all_pairs(spark, monkeypatch):
    plain, compared, plans = hamming.hits, [], []

    def counted(probes, blocks, k):
        compared.append(probes.join(blocks, ["dim", "part", "high"]).agg(F.sum(F.size("block"))).first()[0] or 0)
        out = plain(probes, blocks, k)
        plans.append(out._jdf.queryExecution().optimizedPlan().toString())
        return out

    monkeypatch.setattr(hamming, "hits", counted)
    bits = np.random.default_rng(8).integers(0, 2, (20000, 64)).tolist()
    codes = spark.createDataFrame(list(enumerate(bits)), "id long, bits array<int>").cache()
    queries = codes.filter("id % 1000 = 0").withColumnRenamed("id", "query_id")
    got = {(r.query_id, r["rank"]): (r.distance, r.id) for r in hamming.top_k(codes, queries).collect()}
    matrix = np.array(bits)
    for q in range(0, 20000, 1000):
        away = (matrix != matrix[q]).sum(axis=1)
        assert [got[q, i + 1] for i in range(10)] == [(away[j], j) for j in np.lexsort((np.arange(20000), away))[:10]]
    assert sum(compared) < 20 * 20000
    # Codes are compared by the join, in generated code, and not by functions called for each element.
    assert not any("lambda" in plan for plan in plans)


def test_hamming_of_codes_longer_than_a_word(spark):
    rng = np.random.default_rng(9)
    one = rng.integers(0, 2, 150)
    # Near copies of one code, codes far from all, and too few codes of another length.
    rows = [(i, (one ^ (rng.random(150) < 0.03)).tolist() if i % 2 else rng.integers(0, 2, 150).tolist()) for i in range(500)]
    rows += [(1000 + i, rng.integers(0, 2, 65).tolist()) for i in range(4)]
    codes = spark.createDataFrame(rows, "id long, bits array<int>")
    queries = codes.filter("id in (1, 2, 3, 77, 1000)").withColumnRenamed("id", "query_id")
    longer = spark.createDataFrame([(5, [1] * 200)], "query_id long, bits array<int>")
    got = {}
    for r in hamming.top_k(codes, queries.unionByName(longer), 6).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.distance, r.id))
    for q in (1, 2, 3, 77, 1000):
        bits = dict(rows)[q]
        near = sorted((sum(x != y for x, y in zip(bits, b)), i) for i, b in rows if len(b) == len(bits))[:6]
        assert sorted(got.pop(q)) == [(i + 1, *x) for i, x in enumerate(near)]
    assert not got


def test_mixing_meets_targets(spark, odd):
    rows = [(i, "w " * (i * 37 % 200 + 1), "abcd"[i % 4] if i % 9 else None) for i in range(2000)] + [(5000, "w " * 3, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df).collect()
    size, taken, target = Counter(), Counter(), {}
    for r in got:
        size[r.source] += r.size
        taken[r.source] += r.size * r.copies
        target[r.source] = r.target
        assert 0 <= r.copies <= 3
    weights = {s: k % 3 + 1 for k, s in enumerate(["a", "b", "c", "d", "z", None])}
    want, full = {}, set()
    while True:
        rest = sum(size.values()) - sum(3 * size[s] for s in full)
        level = rest / sum(weights[s] for s in weights if s not in full)
        more = {s for s in weights if s not in full and weights[s] * level > 3 * size[s]}
        if not more:
            break
        full |= more
    want = {s: 3 * size[s] if s in full else weights[s] * level for s in weights}
    for s in weights:
        assert abs(target[s] - want[s]) < 1e-6 * max(1, want[s])
        assert abs(taken[s] - want[s]) <= max(200, 0.01 * want[s])
    again = {r.doc_id: r.copies for r in mixing.mix(df.repartition(5)).collect()}
    assert again == {r.doc_id: r.copies for r in got}
    assert mixing.mix(odd).count() == len(ODD) and mixing.mix(odd.limit(0)).count() == 0


def repeat_words(w):
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    return len({k for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)})


def test_quality_statistics_and_outliers(spark, odd, docs):
    for df in (odd, docs):
        got = Counter(tuple(r)[:6] for r in quality.judge(df).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect())
        want = Counter()
        for r in df.collect():
            w, t = words(r.text), r.text or ""
            lines = [x for x in t.split("\n") if words(x)]
            want[r.doc_id, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), repeat_words(w)] += 1
        assert got == want
    rows = [(i, " ".join(f"w{(i * 31 + k * 7) % 997}" for k in range(60 + i % 40)), "en", "s") for i in range(300)]
    rows += [(1000 + i, " ".join(f"### $$$ x{k}{i}" for k in range(60)), "en", "s") for i in range(12)]
    kept = {r.doc_id: r.kept for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(kept[i] for i in range(300)) and not any(kept[1000 + i] for i in range(12))


def test_quality_judges_small_groups(spark):
    rows = []
    for s in range(30):  # sources of 8 texts, one of them junk; and one of three junk texts only
        rows += [(100 * s + i, " ".join(f"w{(i * 31 + s * 17 + k * 7) % 997}" for k in range(60 + i % 40)), ["en", "de"][s % 2], f"s{s}") for i in range(7)]
        rows.append((100 * s + 50, " ".join(f"### $$$ x{k}{s}" for k in range(60)), ["en", "de"][s % 2], f"s{s}"))
    rows += [(9000 + i, " ".join(f"*** %%% y{k}{i}" for k in range(60)), ["en", None, "xx"][i], "odd") for i in range(3)]
    got = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert all(r.distance is not None for r in got)
    assert {r.doc_id for r in got if not r.kept} == {d for d, *_ in rows if d >= 9000 or d % 100 == 50}


def test_quality_cutoff_follows_the_distances(spark):
    wide = np.random.default_rng(2).chisquare(4, 4000)
    limits = [quality.limit_of(spark.createDataFrame([(float(f * x),) for x in wide] + [(f * 1e4,)] * 400, "distance double")) for f in (2, 20)]
    assert 30 < limits[0] < 60 and abs(limits[1] - 10 * limits[0]) < 0.1 * limits[1]
    assert quality.limit_of(spark.createDataFrame([], "distance double")) == quality.NORMAL_LIMIT


def test_pii_base_spans_match_the_patterns():
    texts = [r[1] or "" for r in ODD] + ["a@b.c.d@e.f 1.2.3.4.5.6.7.8 256.1.1.1 x 4111 1111 1111 1111 +1 2 3", "@x.y a.b@@c.d 4556-7375-8689-9855 +123456789"]
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    for t in texts:
        got = pii.base_spans(t)
        assert [s[1:] for s in got if s[0] == "email"] == [m.span() for m in email.finditer(t)]
        assert [s[1:] for s in got if s[0] == "ip"] == [m.span() for m in ip.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
    assert [s[0] for s in pii.base_spans(texts[-2])].count("card") == 1


def test_pii_network_learns_and_odd_rows_pass(odd):
    rng = np.random.default_rng(1)
    texts = []
    for i in range(260):
        name = "".join(rng.choice(list("abcdefgh"), 6))
        texts.append(f"the and of {name} {['mail ' + name + '@x%d.example.com' % (i % 9), 'from 10.%d.3.%d' % (i % 200, i % 90), 'in 2.0 or 17'][i % 3]} thanked it")
    x = np.stack([pii.window_rows(pii.char_classes(t), [0])[0] for t in texts])
    y = np.stack([pii.tags_of(pii.base_spans(t), 0) for t in texts])
    p = pii.train(x[:200], y[:200], steps=150)
    found = pii.network_spans(texts[200:], p)
    hits = sum({s[:3] for s in f} == set(pii.base_spans(t)) for f, t in zip(found, texts[200:]))
    assert hits >= 48
    rows = {r.doc_id: r for r in pii.find_pii(odd, pii.empty(), redact=True).collect()}
    assert (rows[6].n_email, rows[6].n_ip, rows[6].n_phone) == (1, 1, 1) and "[EMAIL]" in rows[6].redacted
    assert rows[1].base_sha256 == hashlib.sha256(b"").hexdigest() and rows[1].spans == ""


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "pii", "mixing", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.common.staged(stage(spark, docs, sf_dir), name)
        if name != "packing":
            assert docs.columns == before.columns
        if name == "near_duplicates":
            assert docs.count() == docs.select("doc_id").distinct().count() < before.count()
        if name == "pii":
            assert docs.count() == before.count()
            assert not [r for r in docs.collect() if pii.base_spans(r.text)]
    assert docs.agg(F.sum("length")).first()[0] > 0


def test_queries_are_registered():
    names = set(entry.queries())
    assert {"pipeline", *(n for n in names if n.startswith("op"))} <= names and len([n for n in names if re.match(r"op\d+_", n)]) == 13
