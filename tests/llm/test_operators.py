"""Every operator on odd rows, and its query against brute force on the smallest tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from compare import connect, differences
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerline.llm import (
    cells, mixing, near_text, near_vectors, packing, quality, queries, repeats,
    revisits, surrogates, token_files, toxicity,
)
from ledgerline.llm.common import components, ship
from ledgerline.llm.tokens import default_vocabulary
from ledgerline.session import scratch_path

SF_DIR = "/root/testdata/sf0.001"
LONG = " ".join(f"word{n % 700}" for n in range(60_000))
COPY = " ".join(f"copy{n}" for n in range(120))
NEAR = COPY.replace("copy60", "other")
# Columns that clash with what operators add or group by.
CLASH = "doc_id long, text string, lang string, source string, n_chars long, ids string, node long, n_entities int, mix_slot string, vector int, key string, hashes int, kind string"
ROWS = [
    (1, COPY), (2, NEAR), (2, NEAR), (3, None), (4, ""), (5, LONG), (None, COPY), (None, None),
    (6, COPY), (7, " \n\t "), (8, "one two"), (9, "one two"), (-10, NEAR), (11, "é " * 300),
]


@pytest.fixture(scope="module")
def odd(spark):
    ship(spark)
    rows = [(d, t, None, ["a", "b", None][n % 3], n, "x", n, n, "s", n, "k", n, None) for n, (d, t) in enumerate(ROWS)]
    return spark.createDataFrame(rows, CLASH)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where("false")


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"select doc_id, text from '{SF_DIR}/documents.parquet' order by doc_id").fetchall()


@pytest.fixture(scope="module")
def ids_of():
    tokenizer = Tokenizer.from_file(default_vocabulary())
    tokenizer.encode_special_tokens = True
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def union(n: int, links) -> list[int]:
    head = list(range(n))

    def find(x):
        while head[x] != x:
            head[x] = head[head[x]]
            x = head[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        head[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 3), (5, 6), (7, 7), (None, 4), (100, 6)] + [(0 - n, -50) for n in range(1, 50)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert [got[n] for n in (1, 2, 3, 9)] == [1] * 4 and [got[n] for n in (5, 6, 100)] == [5] * 3
    assert all(got[-n] == -50 for n in range(1, 51)) and 7 not in got and 4 not in got


# 1: token-id files


def token_rows(spark, frame):
    path = scratch_path(spark, "test-tokens")
    token_files.write(frame, path, default_vocabulary())
    return token_files.read(spark, path).collect()


def test_token_files_hold_odd_rows(spark, odd, empty, ids_of):
    got = sorted(token_rows(spark, odd), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted([d for d, _ in ROWS], key=lambda d: (d is not None, d or 0))
    assert Counter((r["doc_id"], r["ids"]) for r in got) == Counter((d, np.array(ids_of(t), "<u4").tobytes()) for d, t in ROWS)
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got[:-1]]).tolist()
    assert token_rows(spark, empty) == []


def test_op1(spark, documents, ids_of):
    start, want = 0, []
    for doc_id, text in documents:
        ids = ids_of(text)
        want.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(map(tuple, queries.op1_token_files(spark, SF_DIR).collect())) == want


# 2: quality


def plain_quality(text: str):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    again = Counter(windows)
    covered = {i + n for i, w in enumerate(windows) if again[w] > 1 for n in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return (
        len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(covered),
    )


def hashed(data: bytes, seed: int = 42) -> int:
    value = xxhash.xxh64_intdigest(data, seed)
    return value - (1 << 64) if value >= 1 << 63 else value


def plain_buckets(text: str) -> list[int]:
    words = [hashed(w.encode()) for w in re.findall("[^\x20\x09-\x0d]+", text or "")]
    # A hash of several values takes the first one's hash as the seed of the second.
    pairs = [hashed(b.to_bytes(8, "little", signed=True), hashed(a.to_bytes(8, "little", signed=True)) % (1 << 64)) for a, b in zip(words, words[1:])]
    return [x % quality.BUCKETS for x in words + pairs]


def test_op2(spark, documents):
    good = {r[0] for r in duckdb.sql(f"select doc_id from '{SF_DIR}/labels.parquet' where quality = 1").fetchall()}
    raw, target = np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)
    buckets = {d: plain_buckets(t) for d, t in documents}
    for doc_id, found in buckets.items():
        np.add.at(raw, found, 1)
        if doc_id in good:
            np.add.at(target, found, 1)
    ratio = np.log((target + 1) / (target.sum() + len(target))) - np.log((raw + 1) / (raw.sum() + len(raw)))
    got = {r["doc_id"]: r for r in queries.op2_quality(spark, SF_DIR).collect()}
    for doc_id, text in documents:
        row = got[doc_id]
        n, chars, symbols, lines, repeated = plain_quality(text)
        assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == (n, chars, symbols, lines, repeated)
        failed = n < 10 or 100 * repeated > 20 * n
        score = ratio[buckets[doc_id]].mean() if n else 0.0
        assert row["base_failed"] == failed and math.isclose(row["score"], score, abs_tol=1e-9)
        assert row["kept"] == (not failed and score >= quality.KEEP_FROM)


def test_quality_of_odd_rows(odd, empty):
    trusted = odd.select("doc_id")
    got = quality.quality(odd, trusted).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_repeat_words"]) for r in got) == Counter(
        (d, plain_quality(t)[0], plain_quality(t)[4]) for d, t in ROWS
    )
    assert quality.quality(empty, trusted).collect() == []
    assert len(quality.quality(odd, trusted.where("false")).collect()) == len(ROWS)


# 3: repeated byte strings


def plain_removed(texts: list[bytes], length: int):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    for text in texts:
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - length + 1):
            if seen[text[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        runs = int((np.diff(np.r_[False, gone].astype(int)) == 1).sum())
        yield len(text), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("most_kinds", [512, 1])
def test_op3(spark, documents, monkeypatch, most_kinds):
    monkeypatch.setattr(repeats, "MOST_KINDS", most_kinds)
    want = [(d, *x) for (d, _), x in zip(documents, plain_removed([(t or "").encode() for _, t in documents], 400))]
    assert sorted(map(tuple, queries.op3_repeats(spark, SF_DIR).collect())) == want


def test_repeats_in_odd_rows(odd, empty):
    got = repeats.without_repeats(odd).collect()
    plain = plain_removed([(t or "").encode() for _, t in ROWS], 400)
    want = Counter((d, *x) for (d, _), x in zip(ROWS, plain))
    assert Counter((r[0], r[1], r[2], r[3], hashlib.sha256(r[4]).hexdigest()) for r in got) == want
    assert repeats.without_repeats(empty).collect() == []


@pytest.mark.parametrize("most_kinds", [512, 1])
def test_repeats_of_one_key_and_one_kind(spark, empty, monkeypatch, most_kinds):
    """Many rows without id share a text, many texts share a passage: each way of joining."""
    monkeypatch.setattr(repeats, "MOST_KINDS", most_kinds)
    monkeypatch.setattr(repeats, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(repeats, "HOT_ROWS", 20)
    same = " ".join(f"same{n}" for n in range(90))
    rows = [(None, same)] * 40 + [(n, f"{n} {COPY[:700]} {n}") for n in range(30)]
    rows += [(90, same[:500] + "x"), (91, NEAR), (91, NEAR)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = Counter((d, *x) for (d, _), x in zip(rows, plain_removed([t.encode() for _, t in rows], 400)))
    got = repeats.without_repeats(docs).collect()
    assert Counter((r[0], r[1], r[2], r[3], hashlib.sha256(r[4]).hexdigest()) for r in got) == want


# 4: revisits


def test_op4(spark):
    check = differences(queries.op4_revisits(spark, SF_DIR), connect(SF_DIR), queries.CHECKS["op4_revisits"])
    assert check == []


def test_revisits_of_odd_records(spark):
    u = "HTTPS://www.Example.com:443/a/?b=2&a=1&utm_x=3#top"
    same = "http://example.com/a?a=1&b=2"
    rows = [
        (1, u, 10, 200, {"ETag": '"x"', "Content-Length": "5", "Date": "d1"}),
        (2, same, 20, 304, {"etag": 'W/"x"', "content-length": "0", "date": "d2", "X-New": None}),
        (3, same, 20, 304, {"etag": '"y"'}),
        (4, same, 5, 304, {"etag": '"x"'}),
        (5, same, 30, 304, None),
        (6, None, 30, 304, {}),
        (7, same, None, 304, {}),
        (8, same, 40, 200, None),
        (9, same, 50, 304, {"Last-Modified": "m"}),
        (10, same, 50, 500, {}),
        (11, "http://other.org/", 1, 200, {"last-modified": "m"}),
        (12, "http://other.org", 2, 304, {"last-modified": "m"}),
    ]
    frame = spark.createDataFrame(rows, "record_id long, url string, captured_at long, status int, headers map<string,string>")
    got = {r["record_id"]: r for r in revisits.resolve(frame.selectExpr("*", "1 AS canonical", "'x' AS near")).collect()}
    assert {k: (r["outcome"], r["response_id"]) for k, r in got.items()} == {
        2: ("resolved", 1), 3: ("validator-mismatch", 1), 4: ("no-response", None), 5: ("resolved", 1),
        6: ("no-response", None), 7: ("no-response", None), 9: ("validator-mismatch", 8), 12: ("resolved", 11),
    }
    assert got[2]["headers"] == {"etag": '"x"', "content-length": "5", "date": "d2"}
    assert revisits.resolve(frame.where("false")).collect() == []


def test_revisits_of_one_hot_url(spark):
    records = spark.range(4000).selectExpr(
        "id AS record_id", "'http://a.org/x' AS url", "id AS captured_at", "IF(id % 97 = 0, 200, 304) AS status",
        "map('etag', CAST(id - id % 97 AS STRING)) AS headers",
    )
    got = revisits.resolve(records, chunk_rows=100).collect()
    assert len(got) == 4000 - 42
    assert all(r["response_id"] == r["record_id"] // 97 * 97 and r["outcome"] == "resolved" for r in got)


def test_revisits_of_a_burst_within_one_second(spark):
    """Chunks part records of one URL and one time by their ids."""
    records = spark.range(4000).selectExpr(
        "id AS record_id", "IF(id % 4 = 0, concat('http://b.org/', id % 3), 'http://a.org/x') AS url", "7L AS captured_at",
        "IF(id % 97 = 0, 200, 304) AS status", "CAST(NULL AS map<string,string>) AS headers",
    )
    got = {r["record_id"]: r["response_id"] for r in revisits.resolve(records, chunk_rows=100).collect()}
    last, expected = {}, {}
    for i in range(4000):
        url = i % 3 if i % 4 == 0 else "x"
        if i % 97 == 0:
            last[url] = i
        else:
            expected[i] = last.get(url)
    assert got == expected


# 5: toxicity


def test_toxicity_is_learned_from_texts(spark):
    ship(spark)
    rng = np.random.default_rng(5)
    parts = "ban den fol gar hum kil mor nat pel rud sov tas".split()
    words_of = lambda k: ["".join(parts[x] for x in rng.integers(0, 12, 2)) for _ in range(k)]
    plain, bad = words_of(60), ["killnat", "morrtas", "fooldens", "gaarhum"]
    rows = []
    for n in range(600):
        words = [plain[x] for x in rng.integers(0, 60, 30)]
        if n % 5 == 0:
            words[3], words[17] = bad[n // 5 % 4], bad[n // 5 % 3] + "s,"
        rows.append((n, " ".join(words), int(n % 5 == 0)))
    docs = spark.createDataFrame(rows + [(None, "vile", 1), (9999, None, 0), (9998, "", 0)], "doc_id long, text string, toxic int")
    labels = docs.where("text <> ''").selectExpr("doc_id", "toxic", "'x' AS text")
    got = toxicity.toxicity(docs, labels).collect()
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert len(got) == 603 and len(held) > 100
    assert sum(r["predicted"] == truth.get(r["doc_id"], 0) for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    kept = toxicity.without_toxic(docs, labels).collect()
    assert {r["doc_id"] for r in kept if r["doc_id"]} == {r["doc_id"] for r in got if r["doc_id"] and not r["predicted"]}


def test_toxicity_keeps_every_run_of_characters(spark):
    """More runs than any table of fixed size had places for: each has its own values."""
    ship(spark)
    rng = np.random.default_rng(6)
    letters = list("abcdefghijklmnopqrstuvwxyzäöüßéèàçñåøæ")
    rows = [(n, " ".join("".join(w) for w in rng.choice(letters, (40, 9))), n % 2) for n in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.trained(docs)
    exact = defaultdict(dict)
    for r in model.rows.collect():
        exact[r["table"]][r["run"]] = (r["a"], r["b"])
    assert len(exact[5]) > 80_000

    def plain(word: str) -> float:
        padded, total = "\x02" * 4 + word + "\x03", 0.0
        for end in range(6, len(padded) + 1):
            both = [1 / toxicity.ALPHABET] * 2
            for k in range(1, 6):
                run = padded[end - k : end]
                share, left = exact[k].get(run, (0, 0)), exact[100 + k].get(run[:-1], (1, 1))
                both = [s + w * x for s, w, x in zip(share, left, both)]
            total += math.log(both[0] / both[1])
        return total

    words = [w for _, text, _ in rows[:40] for w in text.split()]
    words += ["".join(w) for w in rng.choice(letters, (2000, 9))] + ["", "a", "𝄞𝄞𝄞𝄞𝄞"]
    assert np.allclose(model.tables.evidence(words), [plain(w) for w in words], atol=1e-9)


def recounted(rows: list[tuple[str, int]]) -> dict[int, dict[str, tuple[float, float]]]:
    """The Kneser-Ney tables of labelled texts, counted one by one in plain Python."""
    counts = [Counter(), Counter()]  # ordinary, toxic
    for text, toxic in rows:
        for raw in set(text.lower().split()):
            padded = toxicity.OPEN * 4 + (raw.strip(toxicity.EDGES) or raw) + toxicity.CLOSE
            for at in range(len(padded) - 4):
                counts[toxic][padded[at : at + 5]] += 1
    out = defaultdict(dict)
    for order in range(5, 0, -1):
        use = counts if order > 3 else [counts[0] + counts[1]] * 2
        runs = set(use[0]) | set(use[1])
        values = []
        for seen in use[1], use[0]:
            once, twice = (sum(n == k for n in seen.values()) for k in (1, 2))
            discount = once / (once + 2 * twice) if once and twice else 0.5
            total, kinds = Counter(), Counter()
            for run, n in seen.items():
                total[run[:-1]] += n
                kinds[run[:-1]] += 1
            share = {r: max(seen[r] - discount, 0) / total[r[:-1]] if total[r[:-1]] else 0.0 for r in runs}
            left = {r[:-1]: discount * kinds[r[:-1]] / total[r[:-1]] if total[r[:-1]] else 1.0 for r in runs}
            values.append((share, left))
        for r in runs:
            out[order][r] = (values[0][0][r], values[1][0][r])
            out[100 + order][r[:-1]] = (values[0][1][r[:-1]], values[1][1][r[:-1]])
        # One order lower, a run counts the different characters before it.
        lower = [Counter(), Counter()]
        for seen, below in zip(counts, lower):
            for run in seen:
                below[run[1:]] += 1
        counts = lower
    return out


def test_toxicity_tables_by_recount(spark):
    """Every share and weight that training makes of the labelled documents."""
    ship(spark)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").where("toxic is not null").select("doc_id", "toxic")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    labelled = docs.join(labels, "doc_id").where("text is not null").selectExpr("text", "CAST(toxic AS int) AS toxic")
    odd_texts = spark.createDataFrame([("", 0), (" !! a", 1), ("«Ä» ä 𝄞𝄞 𝄞", 0), ("same same, SAME", 1)], "text string, toxic int")
    labelled = labelled.unionByName(odd_texts)
    expected = recounted([tuple(r) for r in labelled.collect()])
    got = defaultdict(dict)
    for r in toxicity.trained(labelled).rows.collect():
        assert r["run"] not in got[r["table"]]
        got[r["table"]][r["run"]] = (r["a"], r["b"])
    assert {k: set(v) for k, v in got.items()} == {k: set(v) for k, v in expected.items()}
    for table, runs in expected.items():
        keys = list(runs)
        assert np.allclose([got[table][k] for k in keys], [runs[k] for k in keys], atol=1e-12), table
    # Shares of the runs after a context and what it leaves make one in each model.
    sums = defaultdict(lambda: [0.0, 0.0])
    for order in range(1, 6):
        for run, pair in got[order].items():
            for n in (0, 1):
                sums[order, run[:-1]][n] += pair[n]
    for (order, context), pair in sums.items():
        assert np.allclose(np.add(pair, got[100 + order][context]), 1.0)


def test_toxicity_by_join_is_the_same(spark, odd, monkeypatch):
    ship(spark)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(odd.select("doc_id", "text"))
    model = toxicity.fitted(docs, labels)
    monkeypatch.setattr(toxicity, "fitted", lambda *_: model)
    near, near_kept = toxicity.toxicity(docs, labels).collect(), toxicity.without_toxic(docs, labels).collect()
    model = toxicity.Model(model.rows, None, model.slope, model.offset)
    monkeypatch.setattr(toxicity, "MODEL_ROWS", 0)
    far, far_kept = toxicity.toxicity(docs, labels).collect(), toxicity.without_toxic(docs, labels).collect()
    order = lambda rows: sorted((r["doc_id"] is None, r["doc_id"] or 0, r["score"]) for r in rows)
    assert [x[:2] for x in order(near)] == [x[:2] for x in order(far)]
    assert np.allclose([x[2] for x in order(near)], [x[2] for x in order(far)], atol=1e-9)
    assert len(near_kept) < len(near) and Counter(map(tuple, near_kept)) == Counter(map(tuple, far_kept))


def test_toxicity_of_odd_rows(odd, empty):
    labels = odd.selectExpr("doc_id", "CAST(n_chars % 2 AS INT) AS toxic", "text").unionAll(odd.selectExpr("doc_id", "NULL", "text"))
    assert len(toxicity.toxicity(odd, labels).collect()) == len(ROWS)
    assert {r["score"] for r in toxicity.toxicity(odd, labels.where("false")).collect()} == {0.5}
    assert toxicity.toxicity(empty, labels).collect() == []


# 6: near documents


def plain_classes(rows, similarity=0.8):
    sets = [set(near_text.shingles(t or "").tolist()) if d is not None else set() for d, t in rows]
    links = [
        (a, b)
        for b in range(len(sets)) for a in range(b)
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])
    ]
    counts = Counter(x for link in links for x in link)
    head = union(len(rows), links)
    least = defaultdict(list)
    for n, h in enumerate(head):
        least[h].append(rows[n][0])
    return [(d, min(least[h]) if d is not None else None, counts[n]) for n, ((d, _), h) in enumerate(zip(rows, head))]


def test_op6(spark, documents):
    got = queries.op6_near_documents(spark, SF_DIR).collect()
    assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == sorted(plain_classes(documents))
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in got)


def test_near_documents_among_odd_rows(odd, empty):
    got = near_text.near_documents(odd).collect()
    assert Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == Counter(plain_classes(ROWS))
    assert near_text.near_documents(empty).collect() == []
    kept = near_text.one_of_each_class(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == [-10, 3, 4, 5, 7, 8, 11]


def test_one_group_of_near_copies(spark, monkeypatch):
    """A group far larger than a node or a cell may be loses no link."""
    monkeypatch.setattr(near_text, "SMALL", 8)
    monkeypatch.setattr(near_text, "BLOCK", 16)
    rng = np.random.default_rng(4)
    rows = []
    for n in range(150):
        words = COPY.split()
        for place in rng.integers(0, 120, rng.integers(0, 4)):
            words[place] = f"new{n}x{place}"
        rows.append((n, " ".join(words)))
    ship(spark)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_text.near_documents(frame).collect()
    assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == sorted(plain_classes(rows))


def test_links_that_minhash_values_hide(spark):
    """Pairs at the threshold whose minhash values hardly agree, in clusters of others."""
    ship(spark)
    rows = []
    for n in range(40_000):
        words = [f"w{n}x{k}" for k in range(124)]
        texts = [" ".join(words[:112]), " ".join(words), " ".join(words[12:])]
        low = [near_text.minhash(near_text.shingles(t)) & 255 for t in (texts[0], texts[2])]
        if (low[0] == low[1]).mean() < near_text._screen(0.8):
            rows += [(len(rows) + k, t) for k, t in enumerate(texts)]
        if len(rows) == 9:
            break
    assert len(rows) == 9
    got = near_text.near_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == sorted(plain_classes(rows))
    assert {r["n_links"] for r in got} == {2}


def test_runs_make_up_for_the_screen():
    runs, loss = near_text.runs_needed(0.8, 0.999), near_text.screen_loss(0.8)
    assert 1e-4 < loss < 1.5e-4
    assert (1 - near_text.run_success(0.8, near_text.DEPTH)) ** runs + loss <= 0.001


def test_runs_reach_the_recall():
    runs = near_text.runs_needed(0.8, 0.999)
    assert 1 - (1 - near_text.run_success(0.8, near_text.DEPTH)) ** runs >= 0.999


# 7: surrogates


def test_op7(spark, documents):
    cipher = surrogates.Cipher(queries.SURROGATE_KEY.encode())
    for row in queries.op7_surrogates(spark, SF_DIR).collect():
        text, out, at, n = dict(documents)[row["doc_id"]], "", 0, 0
        for kind, normal, lo, hi in surrogates.found_in(text):
            new = surrogates.surrogate(cipher, kind, normal, 0)
            out += text[at:lo] + surrogates.written_like(kind, new, text[lo:hi])
            at, n = hi, n + 1
        assert (row["text"], row["n_entities"]) == (out + text[at:], n)


def test_surrogates_leave_odd_rows(odd, empty):
    got = surrogates.replace(odd, "k")
    assert set(got.columns) == set(odd.columns)
    assert Counter((r["doc_id"], r["text"], r["n_entities"]) for r in got.collect()) == Counter((d, t, 0) for d, t in ROWS)
    assert surrogates.replace(empty, "k").collect() == []


# 8: near vectors


def plain_links(vectors, threshold=0.95):
    n = len(vectors)
    usable = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for v in vectors]
    links = []
    for b in range(n):
        for a in range(b):
            if usable[a] and usable[b] and len(vectors[a]) == len(vectors[b]):
                x, y = np.array(vectors[a], float), np.array(vectors[b], float)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    links.append((a, b))
    return links


@pytest.mark.parametrize("block", [512, 16])
def test_near_vectors_by_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(near_vectors, "BLOCK", block)
    ship(spark)
    rng = np.random.default_rng(8)
    base = rng.standard_normal((12, 32))
    vectors = [(base[n % 12] + 0.12 * rng.standard_normal(32)).tolist() for n in range(240)]
    vectors += [vectors[0], vectors[0], [2 * x for x in vectors[1]], None, [], [0.0] * 32, [math.nan] * 32, [None] + [1.0] * 31, [1.0, 0.0], [1.0, 0.1], [math.inf] * 32]
    rows = [(n, v, n) for n, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, vector int")
    got = {r["vec_id"]: r for r in near_vectors.near_vectors(frame).collect()}
    links = plain_links(vectors)
    counts, head = Counter(x for link in links for x in link), union(len(vectors), links)
    found = sum(r["n_links"] for r in got.values())
    assert 0.97 * 2 * len(links) <= found <= 2 * len(links)
    assert all(got[n]["n_links"] <= counts[n] for n in got)
    assert sum(got[n]["component_id"] == head[n] for n in got) >= 0.97 * len(vectors)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())
    assert near_vectors.near_vectors(frame.where("false")).collect() == []


def test_op8(spark):
    rows = duckdb.sql(f"select vec_id, embedding from '{SF_DIR}/embeddings.parquet' order by vec_id").fetchall()
    v = np.array([r[1] for r in rows], float)
    cosine = v @ v.T / np.outer(np.linalg.norm(v, axis=1), np.linalg.norm(v, axis=1))
    np.fill_diagonal(cosine, 0)
    got = {r["vec_id"]: r["n_links"] for r in queries.op8_near_vectors(spark, SF_DIR).collect()}
    assert [got[r[0]] for r in rows] == (cosine >= 0.95).sum(1).tolist()


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(9)
    plan = near_vectors.Plan(10, 12)
    turn = near_vectors.rotations(64, plan)
    a, b = (x / np.linalg.norm(x, axis=1)[:, None] for x in rng.standard_normal((2, 2000, 64)))
    b = a * 0.6 + b * 0.8
    b /= np.linalg.norm(b, axis=1)[:, None]
    code, other = np.sign(b @ turn), a @ turn
    factor = np.abs(b @ turn).reshape(2000, -1, 64).sum(2) / 8
    estimate = ((other * code).reshape(2000, -1, 64).sum(2) / 8 / factor).mean(1)
    off = estimate - (a * b).sum(1)
    assert abs(off.mean()) < 0.01 and np.quantile(np.abs(off), 0.99) < 0.3


# 9: packing


def packed_right(rows, ids_of, wanted, capacity):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append(r)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    for doc_id, texts in wanted.items():
        tokens = sorted(tuple(ids_of(t)) for t in texts)
        pieces = sorted(by_doc.pop(doc_id), key=lambda r: r["start"])
        assert sum(r["length"] for r in pieces) == sum(map(len, tokens))
        if len(texts) == 1:
            assert b"".join(r["ids"] for r in pieces) == np.array(tokens[0], "<u4").tobytes()
            assert {r["doc_tokens"] for r in pieces} == {len(tokens[0])}
    assert not by_doc
    return sum(capacity - sum(n for _, n in parts) for parts in by_sequence.values())


def test_op9(spark, documents, ids_of):
    rows = packing.pack(spark.read.parquet(f"{SF_DIR}/documents.parquet"), default_vocabulary()).collect()
    padding = packed_right(rows, ids_of, {d: [t] for d, t in documents}, 1024)
    assert padding < 0.01 * sum(r["length"] for r in rows)
    digests = {(r["doc_id"], r["start"]): r["ids_crc32"] for r in queries.op9_packing(spark, SF_DIR).collect()}
    assert digests == {(r["doc_id"], r["start"]): zlib.crc32(r["ids"]) for r in rows}


@pytest.mark.parametrize("capacity", [1024, 7])
def test_packing_of_odd_rows(odd, empty, ids_of, capacity):
    wanted = defaultdict(list)
    for doc_id, text in ROWS:
        wanted[doc_id].append(text)
    packed = packing.pack(odd, default_vocabulary(), capacity=capacity)
    packed_right(packed.collect(), ids_of, wanted, capacity)
    whole = packing.sequences(packed, capacity).collect()
    assert all(len(r["ids"]) == 4 * r["n_tokens"] and r["n_padding"] == capacity - r["n_tokens"] for r in whole)
    assert packing.pack(empty, default_vocabulary()).collect() == []


@pytest.mark.parametrize("rest", range(1, 1024))
def test_rests_are_cut_into_full_classes(rest):
    parts = packing.cut_rest(rest, 1024)
    assert sum(parts) == rest and len(parts) <= packing.CUTS + 1
    assert all(p == 1024 // packing.class_of(p, 1024) for p in parts[: packing.CUTS])


# 10: mixing


def test_op10(spark):
    check = differences(queries.op10_mixing(spark, SF_DIR), connect(SF_DIR), queries.CHECKS["op10_mixing"])
    assert check == []


def test_mixing_of_odd_rows(odd, empty):
    got = mixing.mixed(odd, block=2)
    assert set(got.columns) == set(odd.columns) | {"mix_block", "mix_slot", "mix_place"}
    rows = got.collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter(ROWS)
    assert len({(r["mix_slot"], r["mix_place"]) for r in rows}) == len(rows)
    assert mixing.mixed(empty).collect() == []


# the pipeline


def test_pipeline(spark, documents, ids_of):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names, before = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, SF_DIR), f"test-{name}")
        assert docs.columns == names
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert set(after) <= set(before)
        if name == "near-copies":
            kept = [(d, t) for d, t in before.items()]
            assert set(after) == {c for _, c, _ in plain_classes(kept)}
        if name == "mixing":
            assert after == before
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert sum(r["n_tokens"] for r in packed) == sum(len(ids_of(t)) for t in before.values())
    assert all(len(r["ids"]) == 4 * r["n_tokens"] <= 4096 for r in packed)


def test_pipeline_of_odd_rows(spark, odd, empty):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for frame in (odd, empty):
        docs = frame.select(columns)
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.written(stage(spark, docs, SF_DIR), "test-odd")
        docs.collect()


def test_packing_follows_the_mix_over_unequal_files(spark):
    """Any prefix of sequences has the sources near the shares of the mix."""
    ship(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = {"a": 3000, "b": 1200, "c": 300}
        rows = [(n, " ".join(f"{name}{n} word" for _ in range(40)), name) for n, name in enumerate(x for x, k in sizes.items() for _ in range(k))]
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
        mixed = mixing.mixed(docs).orderBy("mix_slot", "mix_place").collect()
        path, at = scratch_path(spark, "test-unequal"), 0
        for n in (200, 1300, 100, 1700, 500, 700):
            part = [(r["doc_id"], r["text"], r["source"]) for r in mixed[at : at + n]]
            spark.createDataFrame(part, docs.schema).coalesce(1).write.mode("append").parquet(path)
            at += n
        assert at == len(mixed)
        packed = corpus_pipeline.pack(spark, spark.read.parquet(path), SF_DIR).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    place = {r["doc_id"]: n for n, r in enumerate(mixed)}
    source = {r["doc_id"]: r["source"] for r in mixed}
    packed.sort(key=lambda r: r["sequence_id"])
    assert len({r["sequence_id"] for r in packed}) == len(packed)
    seen, worst = set(), 0
    for r in packed:
        seen.update(r["doc_ids"])
        wanted = Counter(x["source"] for x in mixed[: len(seen)])
        got = Counter(source[d] for d in seen)
        worst = max(worst, max(abs(got[x] - wanted[x]) for x in sizes))
    assert len(seen) == len(mixed) and worst <= 0.03 * len(mixed)
    half = sorted(place[d] for r in packed[: len(packed) // 2] for d in r["doc_ids"])
    assert half[int(0.95 * len(half))] < 0.6 * len(mixed)


def test_cells_of_one_group_see_every_pair(spark):
    ship(spark)
    rows = spark.range(50).selectExpr("id", "7L AS k")
    parts = spark.createDataFrame([(7, 4)], "k long, g int")

    def judge(table, links):
        for a, b in cells.pairs(table):
            links.add(a, b, np.ones(table.num_rows))

    found = cells.compared(cells.spread(rows, "k", "id", parts), judge, "id").collect()
    counts = Counter()
    for r in found:
        counts[r["id"]] += r["n_links"]
    assert counts == {n: 49 for n in range(50)}
