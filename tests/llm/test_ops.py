"""The ten operators against brute force, on special rows: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from docloom.llm import bpe, components, ego, langid, mixing, quality, sharding, similar, simhash, suffixes, vafile, warc

DOCS = "doc_id long, text string, lang string, source string"
WORDS = ["the", "of", "erth", "ingly", "tion", "réau", "übe", "x9"]


def sentence(n, rng):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def special_docs():
    """Rows with every oddity: null ids, texts and sources, copies, repeated rows, long words and texts, controls."""
    rng = random.Random(11)
    shared = sentence(60, rng)
    rows = [(i, sentence(rng.randint(1, 120), rng), "en", f"s{i % 4}") for i in range(40)]
    rows += [(100 + i, f"{sentence(3, rng)} {shared} {sentence(4, rng)}", "en", "s1") for i in range(8)]
    rows += [(200 + i, rows[5][1], "fr", None) for i in range(5)]
    rows += [(300, None, "en", "s2"), (301, "", "en", "s2"), (302, "   \n\t", None, "s2"), (None, shared, "de", "s3"), (None, None, None, None), (None, shared + "!", "de", "s3")]
    rows += [(400, "a" * 700, "en", "s0"), (400, "a" * 700, "en", "s0"), (400, "a" * 650 + "b", "en", "s0"), (401, "é日本" * 300, "en", "s0"), (402, "1234 !?", None, "s1")]
    rows += [(500, sentence(3000, rng), "en", "hot")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(special_docs(), DOCS).withColumn("size", F.lit("clash")).withColumn("score", F.lit(-1)).withColumn("ids", F.lit(0)).withColumn("bucket", F.lit(None).cast("int"))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# --- 1: suffix-array dedup ----------------------------------------------------------------------


def brute_suffixes(rows, length):
    """Per row, in order of (id, hash order given by the caller): covered bytes by plain windows."""
    seen, out = set(), []
    for i, t in rows:
        b = (t or "").encode()
        covered = np.zeros(len(b) + 1, int)
        for k in range(len(b) - length + 1):
            w = b[k : k + length]
            if w in seen:
                covered[k] += 1
                covered[k + length] -= 1
            seen.add(w)
        gone = np.cumsum(covered)[:-1] > 0
        out.append((i, len(b), int(gone.sum()), bytes(np.frombuffer(b, np.uint8)[~gone])))
    return out


@pytest.mark.parametrize(("length", "hot"), [(40, 10_000), (100, 10_000), (100, 2)])
def test_suffixes(spark, docs, length, hot, monkeypatch):
    monkeypatch.setattr(suffixes, "HOT", hot)
    got = suffixes.dedup(docs, length=length).collect()
    # rows of one id are put in order by a hash of their text; the brute-force version is told that order
    order = {(r.doc_id, r.text): r.h for r in docs.select("doc_id", "text", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("h")).collect()}
    rows = sorted(((r[0], r[1]) for r in special_docs()), key=lambda r: (r[0] is not None, r[0] or 0, order[r]))
    want = brute_suffixes(rows, length)
    mine = [(r.doc_id, r.n_bytes, sum(s["end"] - s["start"] for s in r.spans), bytes(r.kept)) for r in got]
    assert Counter(mine) == Counter(want)
    assert all(a["end"] < b["start"] for r in got for a, b in zip(r.spans, r.spans[1:]))


def test_suffixes_random(spark):
    rng = random.Random(3)
    for alphabet in ("ab", "abcdefgh"):
        parts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(30, 400))) for _ in range(12)]
        rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(1, 6)))) for i in range(40)]
        got = {r.doc_id: bytes(r.kept) for r in suffixes.dedup(spark.createDataFrame(rows, "doc_id long, text string"), length=48).collect()}
        assert got == {w[0]: w[3] for w in brute_suffixes(rows, 48)}


def test_suffixes_text_and_pieces(spark, empty, monkeypatch):
    assert suffixes.dedup(empty).count() == 0
    rows = [(1, "é" * 80 + "x"), (2, "ü" + "é" * 80 + "y")]
    out = {r.doc_id: (r.kept, r.carried.k) for r in suffixes.dedup(spark.createDataFrame(rows, "doc_id long, text string").withColumn("k", F.lit("c")), length=100, carry=["k"], as_text=True).collect()}
    assert out[2][0].startswith("ü") and out[2][0].endswith("y") and len(out[2][0]) < 10 and out[1][1] == "c"
    data = bytes(random.Random(1).choices(b"abcd", k=5000))
    whole = {(int(a) + int(o)) for g, f, c, n in suffixes.snippets(data, 100) for a, m in zip(f, c) for o in range(m)}
    assert whole == set(range(len(data) - 99))
    monkeypatch.setattr(suffixes, "PIECE", 777)
    assert {(int(a) + int(o)) for g, f, c, n in suffixes.snippets(data, 100) for a, m in zip(f, c) for o in range(m)} == whole


def test_hot_buckets_are_split(spark, monkeypatch):
    """Few snippets to a part: buckets are split by more grams, round by round, and copies drop in parts."""
    monkeypatch.setattr(suffixes, "HOT", 6)
    rng = random.Random(8)
    common = "".join(rng.choice("abcd") for _ in range(70))
    around = ["".join(rng.choice("abcd") for _ in range(60)) for _ in range(5)]
    rows = [(i, rng.choice(around) + common + rng.choice(around)[: rng.randint(20, 60)] + (common if i % 3 else "")) for i in range(150)]
    got = {r.doc_id: bytes(r.kept) for r in suffixes.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(9), length=100).collect()}
    assert got == {w[0]: w[3] for w in brute_suffixes(rows, 100)}


def test_split_depends_on_the_suffix_alone():
    rng = random.Random(2)
    text = "".join(rng.choice("abcdef") for _ in range(400)).encode()
    for data in (text, text[37:], b"zz" + text):
        for level in (1, 2, 3):
            names = {}
            for _, first, count, near in suffixes.snippets(data, 100):
                for f, c, n in zip(first.tolist(), count.tolist(), near.tolist()):
                    todo = [(f, c, n, 0)]
                    for step in range(1, level + 1):
                        todo = [(f + a, m, n - a, (key, gram)) for f, c, n, key in todo for gram, a, m in suffixes.split(data[f : f + c + 99], n, c, step, 100)]
                    for f, c, n, key in todo:
                        names |= {data[f + k : f + k + 100]: (key, n - k) for k in range(c)}
            assert len(names) == len(data) - 99
            if data is text:
                want = dict(names) if level == 1 else want | names
            else:
                assert all(names[k] == want[k] for k in names if k in want and level == 3)


def test_one_gram_in_100000_snippets(spark):
    rng = random.Random(5)
    grams = ["".join(rng.choice("abcdefgh") for _ in range(32)) for _ in range(20_000)]
    least = min(grams, key=lambda g: int(suffixes._gram_hashes(np.frombuffer(g.encode(), np.uint8))[0]))
    rows = [(i, "".join(rng.choices("abcdefgh", k=75)) + least + "".join(rng.choices("abcdefgh", k=75))) for i in range(100_200)]
    rows += [(200_000 + i, rows[i * 7][1]) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    got = suffixes.dedup(docs, length=100)
    gone = {r.doc_id: r.n for r in got.select("doc_id", F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"]).alias("n")).filter("n > 0").collect()}
    assert gone == {200_000 + i: 182 for i in range(300)}


def test_cover():
    c = suffixes.COVER
    assert {(a - b) % suffixes.PERIOD for a in c for b in c} == set(range(suffixes.PERIOD))
    assert all(any((r + d) % suffixes.PERIOD in c for d in range(8)) for r in range(suffixes.PERIOD))  # at most eight leading bytes


# --- 2: mixing ----------------------------------------------------------------------------------


def brute_targets(sizes, weights=(5, 2, 1), repeats=3):
    """Caps and reshares step by step."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped, budget = set(), sum(sizes.values())
    while True:
        left, total = budget - sum(repeats * sizes[s] for s in capped), sum(w[s] for s in names if s not in capped)
        t = {s: repeats * sizes[s] if s in capped else left * w[s] / total for s in names}
        new = {s for s in names if s not in capped and t[s] > repeats * sizes[s] + 1e-9}
        if not new:
            return t
        capped |= new


def test_targets(spark):
    rng = random.Random(5)
    for _ in range(6):
        sizes = {f"s{i:02}": rng.choice([0, 1, 5, 40, 1000, rng.randint(1, 3000)]) for i in range(rng.randint(1, 12))} | {None: rng.randint(0, 50)}
        got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"), (5, 2, 1), 3, 1.0).collect()}
        want = brute_targets(sizes)
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 * (1 + want[s]) for s in want), (sizes, got, want)


def test_mix(spark, docs, empty):
    rows = mixing.mix(docs).collect()
    text = [(r[0], r[1], r[3]) for r in special_docs()]
    assert len(rows) == len(text) and mixing.mix(empty).count() == 0
    assert Counter((r.doc_id, r.source, r.size) for r in rows) == Counter((i, s, len((t or "").encode().split())) for i, t, s in text)
    sizes, largest, took = Counter({r.source: 0 for r in rows}), Counter(), Counter()
    for r in rows:
        sizes[r.source] += r.size
        took[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
    want = brute_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * (1 + r.target)
    assert sum(took.values()) <= sum(sizes.values())
    assert all(abs(took[s] - want[s]) <= largest[s] for s in sizes)
    assert sorted(map(repr, rows)) == sorted(map(repr, mixing.mix(docs.repartition(7)).collect()))
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in rows)


def test_mix_is_native(docs):
    plan = mixing.mix(docs)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


# --- 3: language --------------------------------------------------------------------------------


def test_network_gradients():
    rng = np.random.default_rng(2)
    net = langid.Network.fresh(["a", "b", "c"], rng)
    ids, labels = rng.integers(0, 257, (5, langid.WINDOW)).astype(np.int16), np.array([0, 1, 2, 1, 0])
    ids[0, 20:] = langid.PAD
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}

    def loss():
        t = np.ascontiguousarray(ids.T)
        p = net._outputs(net._states(t, "f", False)[0].astype(np.float64), net._states(t, "b", False)[0].astype(np.float64))
        live = t != langid.PAD
        return -(np.log(p[:, labels, np.arange(5)]) * live).sum() / live.sum()

    grads = net.gradients(ids, labels)
    for name, w in net.weights.items():
        flat = w.reshape(-1)
        for k in rng.choice(flat.size, 3, replace=False):
            keep = flat[k]
            flat[k] = keep + 1e-2
            up = loss()
            flat[k] = keep - 1e-2
            down = loss()
            flat[k] = keep
            assert abs((up - down) / 2e-2 - grads[name].reshape(-1)[k]) < 2e-3, name


def plain_probabilities(net, data):
    """The network byte by byte: each window forwards and backwards, a probability of each language at every byte, and their mean."""
    sigmoid, h = lambda x: 1 / (1 + np.exp(-x)), langid.UNITS
    total = np.zeros(len(net.languages))
    for at in range(0, len(data), langid.WINDOW):
        ids = list(data[at : at + langid.WINDOW])
        ids += [langid.PAD] * (langid.WINDOW - len(ids))
        states = {}
        for d, order in (("f", range(langid.WINDOW)), ("b", range(langid.WINDOW - 1, -1, -1))):
            s = np.zeros(h)
            for t in order:
                x, g = net.weights["e" + d][:, ids[t]].astype(float), net.weights["u" + d].astype(float) @ s
                z, r = sigmoid(x[:h] + g[:h]), sigmoid(x[h : 2 * h] + g[h : 2 * h])
                s = (1 - z) * s + z * np.tanh(x[2 * h :] + r * g[2 * h :])
                states[d, t] = s
        for t, b in enumerate(ids):
            if b != langid.PAD:
                y = net.weights["o"].astype(float) @ np.concatenate([states["f", t], states["b", t]]) + net.weights["c"][:, 0]
                p = np.exp(y - y.max())
                total += p / p.sum()
    return total / len(data)


def test_prediction_is_the_plain_network(spark):
    net = langid.Network.fresh(["aa", "bb", "cc"], np.random.default_rng(6))
    texts = ["a", "Straße über 12", "x" * 64, "é" * 33, sentence(40, random.Random(1))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in langid.predict(docs, net).collect():
        p = plain_probabilities(net, texts[r.doc_id].encode())
        assert r.lang_pred == net.languages[p.argmax()] and r.score == pytest.approx(p.max(), abs=1e-4)


def test_language(spark, empty):
    rng = random.Random(4)
    make = {"aa": "the of and ing tion wh", "bb": "der die und sch ung ich", "cc": "ción que los para ñ é"}
    rows = [(i, " ".join(rng.choice(make[lang].split()) + rng.choice(make[lang].split()) for _ in range(rng.randint(3, 60))), lang, None) for i, lang in enumerate(list(make) * 60)]
    rows += [(1000, None, "aa", None), (1001, "", "bb", None), (1002, "123 !!", "cc", None), (None, "the ofand ingtion", "zz", None), (1004, "undder schung " * 4000, None, None)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("lang_pred", F.lit("clash"))
    net = langid.fit(docs)
    assert net.languages == ["aa", "bb", "cc"]
    out = {r.doc_id: r for r in langid.predict(docs.drop("lang", "source"), net).collect()}
    held = [r for r in rows[:180] if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert sum(out[r[0]].lang_pred == r[2] for r in held) >= 0.95 * len(held) > 10
    assert all(out[k].lang_pred == "und" and out[k].score == 0 for k in (1000, 1001, 1002))
    assert out[None].lang_pred == "aa" and out[1004].lang_pred == "bb" and all(0 <= r.score <= 1 for r in out.values())
    assert langid.predict(empty, net).count() == 0 and langid.fit(empty).languages == []
    assert langid.predict(docs.drop("lang"), langid.fit(empty)).filter("lang_pred <> 'und'").count() == 0


# --- 4: WARC ------------------------------------------------------------------------------------


def test_framing():
    rng = random.Random(1)
    for n in (0, 1, 4096, 4097, 20000):
        p = "".join(rng.choice("aé日\r\n0 ") for _ in range(n)).encode()
        assert warc.unchunked(warc.chunked(p)) == p
        found = list(warc.parse(iter([b"".join(warc.records("urn:x", 7, "http://x/\r\ny", p, hashlib.sha1(p).digest(), None))])))
        assert all(len(block) <= warc.SEGMENT for _, block in found) and [f["warc-type"] for f, _ in found] == ["response"] + ["continuation"] * (len(found) - 1)
    for broken in (b"", b"5\r\nabc\r\n0\r\n\r\n", b"zz\r\n", b"3\r\nabcXX0\r\n\r\n"):
        with pytest.raises(ValueError):
            warc.unchunked(broken)


def test_warc(spark, tmp_path):
    long, same = "é日x " * 20000, "<p>" + "same " * 300
    rows = [(1, "http://a", long), (2, None, None), (3, "http://c", ""), (4, "u", same), (5, "u", same), (9, "v", same), (9, "w", same), (None, "n", same), (6, "s", "short"), (7, "s", "short"), (None, None, "WARC/1.1\r\n\r\nfake")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).withColumn("n", F.lit(2))
    warc.write(pages, str(tmp_path / "w"))
    whole = warc.reassemble(warc.read_records(spark, str(tmp_path / "w")))
    assert whole.filter("problem IS NOT NULL").count() == 0
    assert {bytes(r.payload).decode() for r in whole.filter("type = 'response'").collect()} == {t or "" for _, _, t in rows}
    got = Counter(tuple(r)[:5] for r in warc.resolve(whole).collect())
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    want = Counter()
    for p, _, t in rows:
        revisit = t == same and (p != 9 or want[(9, len(same), sha(same), "response", None)])
        want[(p, len((t or "").encode()), sha(t), "revisit" if revisit else "response", 9 if revisit else None)] += 1
    assert got == want
    warc.write(pages.limit(0), str(tmp_path / "e"))
    assert warc.reassemble(warc.read_records(spark, str(tmp_path / "e"))).count() == 0


def test_warc_members_and_names(spark, tmp_path):
    """Standard archives: a gzip member per record, any file name, plain ones, records of other types; broken ones are errors."""
    import gzip

    pages = [(k, f"p{k} " * (9000 if k == 3 else 20)) for k in range(5)]
    each = [list(warc.records(f"urn:uuid:{k}", k, "http://x", t.encode(), hashlib.sha1(t.encode()).digest(), None)) for k, t in pages]
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:i>\r\nX: a\r\n b\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    (tmp_path / "crawl-00.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in [info, *sum(each[:3], [])]) + b"\0" * 20)
    (tmp_path / "more.warc").write_bytes(info + b"".join(sum(each[3:], [])))
    (tmp_path / "empty.warc").write_bytes(b"")
    found = warc.read_records(spark, str(tmp_path))
    assert found.filter("type = 'response'").count() == 5 and found.filter("type = 'warcinfo'").count() == 2
    whole = warc.reassemble(found).collect()
    assert {(r.page_id, bytes(r.payload).decode(), r.problem) for r in whole} == {(k, t, None) for k, t in pages}
    data = b"".join(gzip.compress(r) for r in sum(each, []))
    for size in (1, 7, 1 << 20):  # wherever a part ends
        assert [b for _, b in warc.parse(warc.unpacked(data, size))] == [b for _, b in warc.parse([b"".join(sum(each, []))])]
    for broken in (data[:-4], data[:50], b"\x1f\x8bjunk", b"WARC/1.1\r\nX: 1\r\n\r\n", b"junk", b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"):
        with pytest.raises(ValueError):
            list(warc.parse(warc.unpacked(broken)))


def test_warc_damage(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "z" * 50000), (2, "u", "fine")], "page_id long, url string, html string")
    warc.write(pages, str(tmp_path / "w"))
    records = warc.read_records(spark, str(tmp_path / "w"))
    assert records.filter("number IS NOT NULL").count() > 3
    for damage in (records.filter("number IS NULL OR number <> 2"), records.filter("total IS NULL"), records.union(records.filter("number = 2")), records.withColumn("block", F.when(F.col("number") == 2, F.col("block").substr(1, 5)).otherwise(F.col("block")))):
        out = {r.page_id: r.problem for r in warc.reassemble(damage).collect()}
        assert out[1] and out[2] is None


# --- 5: embeddings ------------------------------------------------------------------------------


def special_vectors(rng, n=300, d=12):
    centres = rng.normal(size=(15, d))
    rows = [(i, (centres[i % 15] + 0.3 * rng.normal(size=d)).tolist()) for i in range(n)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)] + [(2000, None), (2001, []), (2002, [0.0] * d), (2003, [float("nan")] * d), (2004, [float("inf")] + [1.0] * (d - 1)), (2005, [1e200] + [0.0] * (d - 1)), (2006, [3e-200] + [0.0] * (d - 1)), (2007, [None, 1.0]), (2008, [5.0]), (7, rows[7][1]), (None, rows[8][1])]
    return rows


def brute_links(rows, cosine):
    ok = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    d = max(len(rows[i][1]) for i in ok)
    m = np.array([rows[i][1] + [0.0] * (d - len(rows[i][1])) for i in ok])
    m = m / np.abs(m).max(axis=1, keepdims=True)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    hit = m @ m.T >= cosine
    np.fill_diagonal(hit, False)
    n, root = Counter(dict(zip(ok, hit.sum(axis=1).tolist()))), {i: i for i in range(len(rows))}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in zip(*np.nonzero(hit)):
        root[find(ok[a])] = find(ok[b])
    least = {}
    for i, (v, _) in enumerate(rows):
        if v is not None:
            least[find(i)] = min(least.get(find(i), v), v)
    return Counter((v, n[i], least.get(find(i)), v is not None and v == least.get(find(i))) for i, (v, _) in enumerate(rows))


def test_ego(spark, monkeypatch):
    monkeypatch.setattr(ego, "INTERVAL_BYTES", 64 * 8 * 12)
    monkeypatch.setattr(ego, "LEAF", 16)
    rows = special_vectors(np.random.default_rng(3))
    for cosine in (0.9, 0.6):
        got = ego.group(spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("n", F.lit(1)), cosine)
        assert Counter(tuple(r) for r in got.collect()) == brute_links(rows, cosine)
    assert ego.group(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert ego.group(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).collect()[0][:] == (1, 0, 1, True)


def test_interval_join_skips_only_distant():
    rng = np.random.default_rng(1)
    points = np.sort(rng.random((64, 1)) * 20, axis=0)
    boxes = [(p - 0.05, p + 0.05) for p in points]
    got = set(ego.join_intervals(boxes, None, 0.5))
    assert got == {(i, j) for i in range(64) for j in range(i, 64) if ego.apart(*boxes[i], *boxes[j]) <= 0.5} and len(got) < 64 * 65 // 4
    got = set(ego.join_intervals(boxes[:20], boxes[15:], 0.5))
    assert got == {(i, j) for i in range(20) for j in range(49) if ego.apart(*boxes[i], *boxes[15 + j]) <= 0.5}
    assert not list(ego.join_intervals([], None, 1)) and not list(ego.join_intervals(boxes, [], 1))


def test_ego_skips_on_clusters(spark, monkeypatch, caplog):
    """On vectors in clusters most pairs of leaves are skipped, and pairs grow with the table, not with its square."""
    monkeypatch.setattr(ego, "LEAF", 32)
    monkeypatch.setattr(ego, "INTERVAL_BYTES", 128 * 8 * 16)
    kept = []
    for n in (1500, 6000):
        rows = [(i, v.tolist()) for i, v in enumerate(clusters(np.random.default_rng(4), n, 16, 0.02))]
        caplog.clear()
        with caplog.at_level("INFO", ego.__name__):
            got = ego.group(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
        skipped, _, everything = (int(x) if x.isdigit() else 0 for x in caplog.messages[-1].split()[:3])
        kept.append(everything - skipped)
        assert skipped > 0.6 * everything
        if n == 1500:
            assert Counter(tuple(r) for r in got) == brute_links(rows, 0.9)
    assert kept[1] < 4**1.2 * kept[0], kept


# --- 6: simhash ---------------------------------------------------------------------------------


def brute_fingerprint(text, size):
    w = [x for x in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate({9: " ", 10: " ", 11: " ", 12: " ", 13: " "}).split(" ") if x]
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + size]).encode(), 42) for i in range(max(1, len(w) - size + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize(("size", "differ"), [(4, 4), (5, 5), (2, 7)])
def test_simhash(spark, docs, empty, size, differ):
    rows = special_docs()
    fps = [brute_fingerprint(t, size) for _, t, _, _ in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= differ:
                a, b = root[i], root[j]
                root = [b if r == a else r for r in root]
    least = {}
    for r, (i, *_) in zip(root, rows):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    got = simhash.group(docs, size, differ, 1).withColumn("hex", simhash.hex16(F.col("fp"))).collect()
    assert Counter((r.doc_id, r.hex, r.component_id) for r in got) == Counter((i, f"{f:016x}", least.get(r)) for (i, *_), f, r in zip(rows, fps, root))
    assert simhash.group(empty).count() == 0 and simhash.keep_one(empty).count() == 0


@pytest.mark.parametrize("differ", [1, 2, 4, 5, 7])
def test_variants_find_every_near_pair(spark, differ):
    rng = random.Random(differ)
    fps = {rng.getrandbits(64) for _ in range(30)}
    for f in list(fps):
        for _ in range(6):
            g = f
            for b in rng.sample(range(64), rng.randint(1, differ + 1)):
                g ^= 1 << b
            fps.add(g)
    signed = {f - (1 << 64) if f >> 63 else f for f in fps}
    nodes = spark.createDataFrame([(f, [f]) for f in signed], "node long, fps array<long>")
    got = {(r.u, r.v) for r in simhash.near(nodes, differ).collect()}
    links = [(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= differ]
    assert reach(got) == reach(links)


def reach(links):
    root = {x: x for e in links for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


def test_more_tables(spark, docs):
    rows = special_docs()
    hashes = [simhash.shingle_hashes(t, 5) for _, t, _, _ in rows]
    fps = [[simhash.fingerprint(simhash.mixed(h, t)) for t in range(3)] for h in hashes]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if any(bin(a ^ b).count("1") <= 6 for a, b in zip(fps[i], fps[j])):
                root = [root[j] if r == root[i] else r for r in root]
    least = {}
    for r, (i, *_) in zip(root, rows):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    got = simhash.group(docs, 5, 6, 3).collect()
    assert Counter((r.doc_id, r.component_id) for r in got) == Counter((i, least.get(r)) for (i, *_), r in zip(rows, root))


@pytest.mark.parametrize("cells", [1 << 21, 200])
def test_keep_one(spark, docs, cells, monkeypatch):
    monkeypatch.setattr(similar, "CELLS", cells)
    rows = sorted(docs.withColumn("h", F.xxhash64("text")).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.h))
    fps = [[simhash.fingerprint(simhash.mixed(simhash.shingle_hashes(r.text, 2), t)) for t in range(2)] for r in rows]
    sets = [set(simhash.shingle_hashes(r.text, 2).tolist()) for r in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if any(bin(a ^ b).count("1") <= 9 for a, b in zip(fps[i], fps[j])):
                root = [root[j] if r == root[i] else r for r in root]
    kept = []
    for i in range(len(rows)):
        if not any(root[i] == root[k] and (not sets[i] | sets[k] or len(sets[i] & sets[k]) >= 0.6 * len(sets[i] | sets[k])) for k in kept):
            kept.append(i)
    got = simhash.keep_one(docs, 2, 9, 2, 0.6)
    assert got.columns == docs.columns and Counter((r.doc_id, r.text) for r in got.collect()) == Counter((rows[k].doc_id, rows[k].text) for k in kept)
    assert len(kept) < len({r.text for r in rows})


def test_keep_one_equal_fingerprints(spark):
    words = lambda n: " ".join(f"w{n}x{k}" for k in range(30))
    rows = [(10 * r + n, f"{words(10 * r + n)} {filler * 400}", "en", "s") for r, filler in enumerate((". ", "0 ", "| ")) for n in range(3)]
    rows += [(90, rows[0][1].upper(), "en", "s"), (91, rows[4][1], "en", "s"), (92, " \x0b\x0c\r", "en", "s"), (93, None, "en", "s"), (94, "\xa0", "en", "s")]
    hashes = [simhash.shingle_hashes(t, 5) for _, t, _, _ in rows[:3]]
    assert len({tuple(simhash.fingerprint(simhash.mixed(h, t)) for t in range(3)) for h in hashes}) == 1
    got = simhash.keep_one(spark.createDataFrame(rows, DOCS), differ=7, tables=3).collect()
    assert sorted(r.doc_id for r in got) == [0, 1, 2, 10, 11, 12, 20, 21, 22, 92, 94]


def test_hot_bucket(monkeypatch):
    monkeypatch.setattr(simhash, "PAIRS", 50)
    rng = np.random.default_rng(0)
    fp = np.array([(1 << int(b)) for b in rng.integers(0, 64, 500)], np.uint64).view(np.int64)
    u, v = simhash.near_in_buckets(np.zeros(500, np.int64), fp, np.arange(500), 2)
    assert len(u) == 499 and (v == 0).all()


def test_components(spark):
    rng = random.Random(9)
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, i) for i in range(1001, 1100)] + [(rng.randint(2000, 2200), rng.randint(2000, 2200)) for _ in range(150)] + [(-5, 7), (-(1 << 63), (1 << 63) - 1)]
    root = {x: x for e in links for x in e}
    for _ in range(70):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {k: v for k, v in root.items() if k in got} and all(k in got for a, b in links if a != b for k in (a, b))
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


# --- 7: BPE -------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    import base64

    import public_tokenizers as p
    import tiktoken

    path = p.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return path, p.PATTERN, tiktoken.Encoding("own", pat_str=p.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe(docs, empty, tokenizer):
    path, pattern, real = tokenizer
    for found in (bpe.decode(bpe.encode(docs, path, pattern), path, pattern), bpe.round_trip(docs.withColumn("copy", F.col("text")), path, pattern).withColumnRenamed("copy", "text")):
        rows = found.collect()
        assert len(rows) == len(special_docs())
        for r in rows:
            assert list(r.ids) == real.encode_ordinary(r.text or "") and bytes(r.decoded).decode() == (r.text or "")
    assert bpe.encode(empty, path, pattern).count() == 0


def merged_one_by_one(vocabulary, word):
    """A list of ids whose leftmost pair of minimum rank is merged until there is none."""
    ranks = {t: i for i, t in enumerate(vocabulary.tokens)}
    parts = [bytes([b]) for b in word]
    while pairs := [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]:
        i = min(pairs)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


def test_bpe_random(tokenizer):
    path, pattern, real = tokenizer
    vocabulary = bpe.Vocabulary(bpe.read_ranks(path))
    encoder = bpe.Encoder(vocabulary, pattern)
    rng = random.Random(2)
    texts = ["".join(chr(rng.choice([rng.randint(1, 127), rng.randint(128, 0x2FFF), 32, 10, 0x1F600])) for _ in range(rng.randint(0, 80))) for _ in range(300)]
    texts += ["a" * 3000, "ab" * 400, " " * 500, "\x1c\x85 　x", "<|endoftext|>", "İİſ", "".join(rng.choice("abcdefgh") for _ in range(2000))]
    ids, at = encoder.encode(texts)
    for i, t in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == real.encode_ordinary(t)
    rows = ["antidisestablishmentarianism" * 12, "é" * 40, "a" * 300, "abab" * 70 + "a", "日本語" * 50] + ["".join(rng.choice("aeinrst") for _ in range(300)) for _ in range(40)]
    rows += ["".join(rng.choice("aeinrst") for _ in range(n)) for n in (255, 256, 257, 511, 512, 513, 1500)]  # blocks' edges
    for found in (vocabulary.encode_pieces([w.encode() for w in rows]), vocabulary._matrix([w.encode() for w in rows], 2048)):
        for ids, word in zip(found, rows):
            assert ids.tolist() == merged_one_by_one(vocabulary, word.encode())


def test_bpe_lower_ranks_come_first():
    """Ranks in an order that no training gives: a merge may make a pair of a lower rank."""
    import base64

    rng = random.Random(7)
    for _ in range(30):
        tokens = {bytes([b]) for b in b"abc"} | {"".join(rng.choice("abc") for _ in range(rng.randint(2, 5))).encode() for _ in range(25)}
        order = sorted(t for t in tokens if len(t) == 1) + rng.sample(sorted(t for t in tokens if len(t) > 1), sum(len(t) > 1 for t in tokens))
        vocabulary = bpe.Vocabulary(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(order)))
        for n in (1, 2, 7, 400):
            word = "".join(rng.choice("abc") for _ in range(n)).encode()
            assert vocabulary._matrix([word], 512)[0].tolist() == merged_one_by_one(vocabulary, word)


def test_bpe_long_texts(spark, tokenizer):
    path, pattern, real = tokenizer
    rng = random.Random(12)
    texts = ["x" * 200_000, "".join(rng.choice("abcdefghij") for _ in range(20_000)), " \n" * 50_000, "the cat " * 60_000, "z" * 70_000 + "ä日" * 9_000]
    rows = bpe.round_trip(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("decoded", F.lit(1)), path, pattern).collect()
    for r in rows:
        assert list(r.ids) == real.encode_ordinary(texts[r.doc_id]) and bytes(r.decoded).decode() == texts[r.doc_id]
    clash = bpe.decode(bpe.encode(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), path, pattern).withColumn("decoded", F.lit(1)), path, pattern)
    assert clash.columns == ["doc_id", "text", "ids", "decoded"] and bytes(clash.first().decoded) == b"a b"


# --- 8: quality ---------------------------------------------------------------------------------


def test_quality(spark, empty):
    rng = random.Random(6)
    clean = lambda: " ".join(rng.choice(WORDS) for _ in range(rng.randint(5, 80))).capitalize() + "."
    junk = lambda: " ".join(rng.choice(WORDS).upper() + rng.choice(["!!", "$$", "%%"]) for _ in range(rng.randint(5, 80)))
    rows = [(i, clean() if i % 3 else junk(), "en", None) for i in range(300)] + [(900, None, None, None), (901, "", None, None), (902, junk() * 500, None, None), (None, clean(), None, None)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("predicted", F.lit("clash"))
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(300)] + [(5, 1, 0), (None, 1, 0), (17, None, 0), (18, 7, 0)], "doc_id long, quality int, toxic int")
    space = quality.fit(docs, labels)
    out = {r.doc_id: r for r in quality.score(docs, space).collect()}
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 30 and sum(out[i].predicted == int(i % 3 > 0) for i in held) >= 0.95 * len(held)
    assert out[902].predicted == 0 and out[None].predicted == 1 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out.values())
    assert out[900].score == out[901].score == pytest.approx(space.prior)
    assert quality.score(empty, space).count() == 0
    assert quality.score(docs, quality.fit(empty, labels)).filter("score <> 0.5").count() == 0


M64 = (1 << 64) - 1


def plain_terms(data):
    """The terms of a text word by word, in plain numbers."""

    def mixed(h):
        h = (h ^ h >> 31) * 0xBF58476D1CE4E5B9 & M64
        return h ^ h >> 29

    kind = lambda b: 0 if b in b" \t\n\x0b\x0c\r" else 1 if 97 <= b <= 122 or b >= 128 else 2 if 65 <= b <= 90 else 3 if 48 <= b <= 57 else b + 4
    mix, out = 0x9E3779B97F4A7C15, Counter()
    found, lines = [], []
    for line in data.split(b"\n"):
        here = line.split()
        if here:
            found += here
            lines.append(here)
    if not found:
        return out

    def shape(w):
        runs = [k for i, k in enumerate(map(kind, w)) if i == 0 or kind(w[i - 1]) != k]
        return sum(mixed((k * mix + min(i, 7)) & M64) for i, k in enumerate(runs)) & M64

    def word(w):
        return mixed(sum(int(quality._LETTER[min(i, 31), b]) for i, b in enumerate(w)) & M64)

    shapes, words = [shape(w) for w in found], [word(w) for w in found]
    whole = {sum(mixed((word(w) + mix * (i + 1)) & M64) for i, w in enumerate(ws)) & M64 for ws in lines}
    share = lambda some, n: -(-8 * len(some) // n)
    seen = [*shapes, *((min(len(w), 20) + mix) & M64 for w in found), len(found).bit_length() + (1 << 40), share(set(words), len(words)) + (1 << 41), share(whole, len(lines)) + (1 << 42), *((3 * a + b) & M64 for a, b in zip(shapes, shapes[1:]))]
    out.update(mixed(h) % quality.SHAPES for h in seen)
    out.update(quality.SHAPES + h % quality.WORDS for h in [*words, *(mixed((3 * a + b) & M64) for a, b in zip(words, words[1:]))])
    return out


def test_terms_are_plain_ones():
    rng = random.Random(3)
    texts = ["", " \n\t", "x", "the cat sat on a mat today", "xqz wvk jjq zz q vvv kkkkk", "A-1 b2B.\n\n same line\n same line \nx" + "y" * 80, *(t or "" for _, t, _, _ in special_docs())]
    texts += ["".join(rng.choice("aB9 .é\n") for _ in range(rng.randint(1, 300))) for _ in range(40)]
    for t in texts:
        assert {i: int(n) for i, n in enumerate(quality.terms(t.encode())) if n} == dict(plain_terms(t.encode())), t
    one, two = (quality.terms(t.encode()) for t in texts[3:5])
    assert (one[quality.SHAPES :] != two[quality.SHAPES :]).any()  # words count, not only their shapes


def test_quality_end_to_end(spark):
    """Scores of documents from their texts by plain sums over words and labelled documents."""
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(WORDS if i % 3 else ["BUY", "!!!", "now", "$$$", "9x"]) for _ in range(rng.randint(2, 50))), "en", None) for i in range(160)]
    docs = spark.createDataFrame(rows, DOCS)
    space = quality.fit(docs, spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(160)], "doc_id long, quality int"))
    taught = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    counts = {r[0]: plain_terms(r[1].encode()) for r in rows}
    weight = [np.log((1 + len(taught)) / (1 + sum(t in counts[r[0]] for r in taught))) + 0.1 for t in range(quality.TERMS)]

    def vector(i):
        halves = []
        for low, high, w in ((0, quality.SHAPES, 1.0), (quality.SHAPES, quality.TERMS, quality.WORD_WEIGHT)):
            h = {t: np.log1p(n) * weight[t] for t, n in counts[i].items() if low <= t < high}
            norm = sum(x * x for x in h.values()) ** 0.5
            halves += [(t, x * w / norm) for t, x in h.items()]
        v = sum(x * space.axes[t].astype(float) for t, x in halves)
        return v / np.sqrt((v * v).sum())

    known = [(vector(r[0]), int(r[0] % 3 > 0)) for r in taught]
    for r in quality.score(docs, space).collect():
        v = vector(r.doc_id)
        near = sorted(((float(v @ k), y) for k, y in known), reverse=True)
        if near[quality.NEIGHBOURS - 1][0] - near[quality.NEIGHBOURS][0] < 1e-5:
            continue  # a tie that rounding decides
        votes = [(max(c, 0) ** quality.SHARPNESS, y) for c, y in near[: quality.NEIGHBOURS]]
        assert r.score == pytest.approx(sum(w * y for w, y in votes) / sum(w for w, _ in votes), abs=1e-3)


def test_scores_are_exact_votes():
    rng = np.random.default_rng(1)
    counts = rng.poisson(0.3, (200, quality.TERMS)).astype(np.float32)
    space = quality.Space(counts[:120], rng.integers(0, 2, 120))
    v = space.project(counts[120:])
    for s, row in zip(space.scores(counts[120:], 7), v):
        c = space.vectors @ row
        best = np.argsort(-c)[:7]
        w = np.maximum(c[best].astype(float), 0) ** quality.SHARPNESS
        assert s == pytest.approx((w * space.labels[best]).sum() / w.sum(), rel=1e-4)


# --- 9: top-k search ----------------------------------------------------------------------------


def test_vafile(spark, monkeypatch):
    monkeypatch.setattr(vafile, "BLOCK", 50)
    monkeypatch.setattr(vafile, "QUERIES", 7)
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=8).round(1).tolist()) for i in range(200)] + [(300 + i, [0.5] * 8) for i in range(30)] + [(400, None), (420, [1.0, float("nan")]), (440, [None]), (460, []), (480, [2.0]), (500, [-3.0] * 10), (None, [9.0] * 8)]
    got = Counter(tuple(r) for r in vafile.topk(spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(0)), F.col("vec_id") % 20 == 0, 20, 64.0).collect())
    ok = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    want = Counter()
    for q, qv in ok:
        if q % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in ok if i != q)[:20]
            want.update((q, n, i, -s) for n, (s, i) in enumerate(best, 1))
    assert got == want
    assert vafile.topk(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True), 20, 64.0).count() == 0
    assert vafile.topk(spark.createDataFrame([(20, [1.0])], "vec_id long, embedding array<float>"), F.lit(True), 20, 64.0).count() == 0


def brute_top(rows, is_query, k, scale):
    ok = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    want = Counter()
    for q, qv in ok:
        if is_query(q):
            best = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in ok if i != q)[:k]
            want.update((q, n, i, -s) for n, (s, i) in enumerate(best, 1))
    return want


def test_vafile_large_components(spark):
    rng = np.random.default_rng(1)
    rows = [(20, [1e8, 0.5, 0.0]), (1, [0.02, 0.0, 0.0]), (2, [2e6, 1.0, 3.0]), (3, [-1e6, 0.0, 0.25]), (40, [1.0, 2.0])] + [(100 + 2 * i + 1, (rng.normal(size=3) * 10.0 ** rng.integers(-2, 6)).tolist()) for i in range(60)]
    schema = "vec_id long, embedding array<double>"
    got = Counter(tuple(r) for r in vafile.topk(spark.createDataFrame(rows, schema), F.col("vec_id") % 20 == 0, 200, 64.0).collect())
    assert got == brute_top(rows, lambda q: q % 20 == 0, 200, 64) and (20, 1, 2) in {t[:3] for t in got}
    assert {t[3] for t in got if t[0] == 20 and t[2] == 1} == {6_400_000_000}
    with pytest.raises(Exception, match="64 bits"):
        vafile.topk(spark.createDataFrame([(20, [1e10]), (1, [1e10])], schema), F.col("vec_id") == 20, 2, 64.0).collect()
    rows = [(20, [1e10, 1.0]), (1, [0.5, 1.0]), (2, [-2e5, 0.0])]  # sums within 64 bits of products that need exact numbers
    got = Counter(tuple(r) for r in vafile.topk(spark.createDataFrame(rows, schema), F.col("vec_id") == 20, 2, 64.0).collect())
    assert got == brute_top(rows, lambda q: q == 20, 2, 64)


def clusters(rng, n, d, spread, each=100):
    """n unit vectors, `each` of them about every centre, so that links grow with the table."""
    m = np.repeat(rng.normal(size=(-(-n // each), d)), each, axis=0)[:n] + spread * rng.normal(size=(n, d))
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def test_vafile_skips_on_clusters(spark, monkeypatch, caplog):
    monkeypatch.setattr(vafile, "BLOCK", 50)
    monkeypatch.setattr(vafile, "QUERIES", 20)
    rows = [(i, v.tolist()) for i, v in enumerate(clusters(np.random.default_rng(2), 1000, 16, 0.05))]
    with caplog.at_level("INFO", vafile.__name__):
        got = Counter(tuple(r) for r in vafile.topk(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, 20, 64.0).collect())
    assert got == brute_top(rows, lambda q: q % 20 == 0, 20, 64)
    skipped, _, everything = caplog.messages[-1].split()[:3]
    assert int(skipped) > 0.4 * int(everything)


def test_certain_reads_in_order():
    rng = np.random.default_rng(5)
    data, q = np.floor(rng.normal(size=(500, 8)) * 60), np.floor(rng.normal(size=8) * 60)
    exact = (data @ q).astype(int)
    ids, scores, read = vafile.certain(q, np.arange(500), data, exact + 50.0, 10)
    want = sorted(range(500), key=lambda i: (-exact[i], i))[:10]
    assert ids.tolist() == want and scores.tolist() == exact[want].tolist() and read < 200


# --- 10: sharding -------------------------------------------------------------------------------


def brute_owner(i, weights):
    def score(s, w):
        x = int(hashlib.md5(f"{'' if i is None else i}/{s}".encode()).hexdigest()[:15], 16)
        return -np.log((float(x) + 0.5) / (1 << 60)) / w

    return min(range(len(weights)), key=lambda s: score(s, weights[s]) if weights[s] else float("inf"))


@pytest.mark.parametrize("weights", [[1.0] * 24, [1.0, 3.0, 0.0, 2.0]])
def test_sharding(spark, docs, empty, weights):
    rows = sharding.shard(docs, weights).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in rows) == Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), brute_owner(i, weights), brute_owner(i, [*weights, 1.0])) for i, t, _, _ in special_docs())
    by = {}
    for r in rows:
        assert r.law == "key" and r.grown_shard in (r.shard, len(weights))
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert sharding.shard(empty, weights).count() == 0


def test_sharding_follows_weights(spark):
    n = Counter(r.s for r in spark.range(20000).select(sharding.owner(F.col("id"), [1.0, 2.0, 5.0]).alias("s")).collect())
    assert abs(n[0] / 20000 - 1 / 8) < 0.01 and abs(n[2] / 20000 - 5 / 8) < 0.015
