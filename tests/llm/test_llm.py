"""Each operator against brute force on small tables, with nulls, blanks, repeats, long texts and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from provlake.llm import fm_index, op1_licenses, op2_bpe, op3_substring, op4_simhash, op5_ann, op6_token_files, op7_html, op8_url_filter, op9_decontaminate, op10_toxicity, range_coder

RNG = random.Random(7)
VOCAB = ["".join(RNG.choice("abcdefghij") for _ in range(RNG.randint(1, 6))) for _ in range(60)]


def words(n, rng=RNG):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


PASSAGE, LICENSE = words(60), "Released under the MIT License."
TEXTS = [None, "", " \t\n ", "one", "Two words", PASSAGE, words(20) + " " + PASSAGE + "\n" + words(30), words(400), words(5000), "x " * 200, "y y y " * 30, "ÄÖ ü  é <|endoftext|> don't !! \x1c z", "a  b\n\n c\r\n  d ", "All rights reserved. " + words(15), words(50) + " " + LICENSE + " " + words(50)]
TEXTS += [TEXTS[7], TEXTS[7] + " tail", TEXTS[6].upper(), "Z" * 3000, "é" * 1500 + " " + words(300)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None, "src0", -1, "clash") for i, t in enumerate(TEXTS)] + [(7, TEXTS[7], "en", None, 1, "rep"), (None, "no id here", None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, h string")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def listed(df):
    return sorted(map(tuple, df.collect()), key=str)


def pairs():
    return [*enumerate(TEXTS), (7, TEXTS[7]), (None, "no id here")]


def test_bpe(docs, empty):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(op2_bpe.vocabulary())
    want = []
    for i, t in pairs():
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert listed(op2_bpe.encode(docs, output="digest")) == sorted(want, key=str)
    full = {r.doc_id: r for r in op2_bpe.encode(docs).collect()}
    assert full[11].ids == tok.encode(TEXTS[11], add_special_tokens=False).ids
    assert op2_bpe.encode(empty).count() == 0


def test_bpe_chunks():
    data = (words(3000) + TEXTS[11] * 40).encode()
    cuts = op2_bpe.cut_points(data)
    assert cuts[-1] == len(data) and all(data[a] & 0xC0 != 0x80 for a in cuts[:-1])
    codec, joined = op2_bpe.Codec(op2_bpe.vocabulary()), words(9000)
    calls = []
    library = codec.tok

    class Counted:
        def encode_batch_fast(self, texts, **options):
            calls.append(sum(map(len, texts)))
            return library.encode_batch_fast(texts, **options)

        decode, decode_batch = library.decode, library.decode_batch

    codec.tok = Counted()
    for text in (joined + joined, joined, "x" * 300_000, "", joined + " tail"):
        assert codec.encode([text])[0][0].tolist() == library.encode(text, add_special_tokens=False).ids
    # what came before is not encoded again
    assert sum(calls) < len(joined) / 2 + 300_000 + 1000


def test_bpe_random():
    rng, codec = random.Random(3), op2_bpe.Codec(op2_bpe.vocabulary(), held=4000, pieces=30)
    bits = ["a", "b'", " ", "  ", "\n", "\t", "é", "'s", "1", " ", "!", "\x1f", "\xa0", "\x0b", "<|endoftext|>", "日本"]
    for _ in range(100):
        batch = ["".join(rng.choice(bits) for _ in range(rng.choice([5, 50, 900]))) for _ in range(3)]
        for t, (ids, decoded) in zip(batch, codec.encode(batch)):
            e = codec.tok.encode(t, add_special_tokens=False).ids
            assert ids.tolist() == e and decoded == codec.tok.decode(e, skip_special_tokens=False)


def brute_removed(texts, window=35):
    split = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("crowded", [1000, 0])
def test_substring(docs, empty, crowded):
    got = op3_substring.removals(docs, crowded=crowded, shard_words=2000)
    want = [(i, *x) for (i, _), x in zip(pairs(), brute_removed([t for _, t in pairs()]))]
    assert listed(got) == sorted(want, key=str)
    if crowded:
        assert op3_substring.remove_repeats(empty).count() == 0
        clash = docs.withColumns({c: F.lit(c) for c in ("spans", "op3_key", "OP3_SPANS", "_key")})
        kept = op3_substring.stage(None, clash, "")
        assert kept.columns == clash.columns and {tuple(r)[6:] for r in kept.collect()} == {("spans", "op3_key", "OP3_SPANS", "_key")}
        assert sorted((str(r.doc_id), len((r.text or "").split())) for r in kept.select("doc_id", "text").collect()) == sorted((str(w[0]), w[1] - w[2]) for w in want if True)


@pytest.mark.parametrize("crowded", [3, 0])
def test_substring_of_crowded_minimizers(spark, crowded):
    """Near copies, a common line between other words, and periodic texts of several lengths, all with crowded minimizers."""
    rng = random.Random(19)
    base, line = words(150, rng).split(), words(12, rng)
    texts = [" ".join(w if rng.random() > 0.02 else rng.choice(VOCAB) for w in base) for _ in range(40)]
    texts += [words(rng.randint(0, 60), rng) + " " + line + " " + words(rng.randint(0, 60), rng) for _ in range(40)]
    texts += ["x " * rng.randint(30, 90) + words(rng.randint(0, 9), rng) for _ in range(12)] + ["a b c " * rng.randint(10, 40) + words(3, rng) for _ in range(12)]
    got = op3_substring.removals(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), crowded=crowded, shard_words=2000)
    assert listed(got) == sorted(((i, *x) for i, x in enumerate(brute_removed(texts))), key=str)


def test_substring_rows_of_crowded_minimizers():
    """A crowded segment of 28 windows around one place gives a row per block, a periodic one a single row."""
    import pyarrow as pa

    rng = random.Random(23)
    texts, needs = [" ".join(f"{rng.random():.9f}" for _ in range(4000)), "x " * 4000], []
    for text in texts:
        s = op3_substring.Segments([text], 35, 8)
        needs.append([{"key": int(s.key[i]), "print": int(s.print[i]), "start": int(s.start[i]), "count": int(s.count[i]), "many": False, "hot": True} for i in range(len(s.key))])
    batch = pa.RecordBatch.from_pydict({"text": texts, "need": needs})
    rows = [r["key"] for b in op3_substring._needed(35, 8, 1)(iter([batch])) for r in b.to_pylist()]
    count = Counter(rows)
    assert sum(map(len, needs)) > 200 and all(count[x["key"]] <= 4 for need in needs for x in need) and count[needs[1][0]["key"]] == 1


def test_repeated_windows_random():
    rng = np.random.RandomState(5)
    for _ in range(60):
        n, window = rng.randint(40, 300), int(rng.randint(2, 9))
        body = rng.randint(1, rng.choice([2, 3, 8]) + 1, n)
        seq = np.concatenate(([0], body, [0])).astype(np.int64)
        found = fm_index.repeated_windows(fm_index.FMIndex(seq, int(seq.max()) + 1), seq, np.array([1]), np.array([n - window + 1]), window)[0]
        seen = Counter(tuple(body[i : i + window]) for i in range(n - window + 1))
        want, got = np.zeros(n, bool), np.zeros(n, bool)
        for i in range(n - window + 1):
            if seen[tuple(body[i : i + window])] > 1:
                want[i : i + window] = True
        for i in found:
            got[i : i + window] = True
        assert (want == got).all()


def test_simhash(spark, docs, empty):
    got = {(r.doc_id, r.fp): r.component_id for r in op4_simhash.near_duplicates(docs).collect()}
    prints = {i: op4_simhash.fingerprint(t) for i, t in enumerate(TEXTS)}
    par = {i: i for i in prints}

    def find(a):
        while par[a] != a:
            a = par[a]
        return a

    for a in prints:
        for b in prints:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                par[y] = x
    assert {i: c for (i, _), c in got.items() if i is not None} == {i: find(i) for i in prints}
    assert op4_simhash.near_duplicates(docs).count() == len(TEXTS) + 2 and op4_simhash.near_duplicates(empty).count() == 0
    words_ = "b c D".lower().encode()
    import xxhash

    assert op4_simhash.fingerprint("B c d") == xxhash.xxh64_intdigest(words_, 42)


@pytest.mark.parametrize("crowded", [64, 1])
def test_simhash_links(spark, crowded):
    rng = random.Random(2)
    fps = {rng.getrandbits(64) for _ in range(30)}
    for f in list(fps):
        for _ in range(4):
            f ^= 1 << rng.randrange(64)
            fps.add(f)
    fps = sorted(fps)
    df = spark.createDataFrame([(op4_simhash._signed(f), i) for i, f in enumerate(fps)], "fp long, rep long")
    comp = dict((r.node, r.component) for r in op4_simhash.components(op4_simhash.links(df, crowded=crowded)[0]).collect())
    par = list(range(len(fps)))

    def find(a):
        while par[a] != a:
            a = par[a]
        return a

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                par[y] = x
    assert all(comp.get(i, i) == find(i) for i in range(len(fps)))


def test_decontamination(spark, docs, empty):
    items = [(1, PASSAGE.upper()), (2, "one"), (3, " ".join(TEXTS[7].split()[100:120])), (4, None), (5, "..."), (6, "x x x x x"), (10, "two  WORDS"), (10, "two words"), (11, words(40))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    pat, low = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), str.maketrans({c: chr(c + 32) for c in range(65, 91)})
    cut = lambda t: pat.findall((t or "").translate(low))
    win = {}
    for i, t in items:
        w = cut(t)
        n = min(13, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            win.setdefault(tuple(w[s : s + n]), set()).add(i)
    want = []
    for i, t in pairs():
        w, hit, it = cut(t), set(), set()
        for n in {len(k) for k in win}:
            for s in range(len(w) - n + 1):
                if k := win.get(tuple(w[s : s + n])):
                    hit.update(range(s, s + n))
                    it |= k
        want.append((i, len(w), len(hit), len(it), hashlib.sha256(",".join(sorted(map(str, it))).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    assert listed(op9_decontaminate.verdicts(docs, bench)) == sorted(want, key=str)
    assert op9_decontaminate.verdicts(empty, bench).count() == 0
    assert op9_decontaminate.verdicts(docs, bench.limit(0)).where("contaminated").count() == 0


def test_decontamination_by_row(spark):
    rng = random.Random(11)
    texts = [words(60, rng) for _ in range(12)]
    bench = spark.createDataFrame([(i, " ".join(t.split()[:25])) for i, t in enumerate(texts[:6])], "item_id long, text string")
    ids = [None, None, 7, 7, 7, 3, None, None, 7, 7, 3, 3]
    docs = spark.createDataFrame([*zip(ids, texts), (7, texts[2] + " " + words(5, rng))], "doc_id long, text string")
    one, many = listed(op9_decontaminate.verdicts(docs, bench)), listed(op9_decontaminate.verdicts(docs, bench, most_bits=7))
    assert one == many and sum(r[5] for r in many) == 7
    assert [r[2] for r in many if r[5]] == [25] * 7 and not any(r[2] for r in many if not r[5])


def test_decontamination_of_long_texts(spark):
    """A text that is benchmark throughout, and one whose every word is an item."""
    rng = random.Random(21)
    item = words(3000, rng)
    docs = spark.createDataFrame([(1, item + " " + item), (2, "a " * 30_000), (3, words(4000, rng))], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, "a"), (None, "a a")], "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in op9_decontaminate.verdicts(docs, bench).collect()}
    n = sum(w == "a" for w in item.split())
    assert got[1] == (6000, 6000, 2 if n else 1) and got[2] == (30_000, 30_000, 1) and got[3][1] < 4000


def test_licenses(spark, docs, empty):
    got = {(r.doc_id, r.license): r.containment for r in op1_licenses.scan(docs, op1_licenses.templates(spark)).collect()}
    assert got == {(13, "LicenseRef-all-rights-reserved"): 1.0, (14, "MIT"): 1.0}
    assert op1_licenses.scan(empty, op1_licenses.templates(spark)).count() == 0
    long = dict(op1_licenses.TEMPLATES)["BSD-3-Clause"].split()
    near = spark.createDataFrame([(i, words(i) + " " + " ".join([*long[:-1], "else"]) + " " + words(90)) for i in range(40)] + [(99, words(20) + " " + " ".join(long[:12]) + " " + words(20))], "doc_id long, text string")
    assert {r.doc_id for r in op1_licenses.scan(near, op1_licenses.templates(spark)).collect()} == set(range(40))
    every = spark.createDataFrame([(i, words(i) + " " + t + " " + words(70 - i)) for i in range(70) for t in [op1_licenses.TEMPLATES[i % 11][1]]], "doc_id long, text string")
    found = {(r.doc_id, r.license) for r in op1_licenses.scan(every, op1_licenses.templates(spark)).collect()}
    assert {(i, op1_licenses.TEMPLATES[i % 11][0]) for i in range(70)} <= found


def test_licenses_of_one_shingle(spark):
    rng = random.Random(13)
    texts = [f"{words(100, rng)} {line} {words(100, rng)}" for _ in range(1500) for line in ["Released under the MIT License"]]
    got = op1_licenses.scan(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string"), op1_licenses.templates(spark)).collect()
    assert {r.doc_id for r in got if r.license == "MIT"} == set(range(1500)) and all(r.n_places == 2 for r in got)


def test_licenses_of_long_texts(spark):
    """Segments meet without a gap, at every place of the line in a text of several segments."""
    rng, line = random.Random(17), dict(op1_licenses.TEMPLATES)["BSD-3-Clause"]
    step = op1_licenses.SEGMENT * op1_licenses.STRIDE
    texts = [f"{words(step - 40 + i, rng)} {line} {words(2 * step, rng)} All rights reserved" for i in range(0, 80, 3)]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").withColumn("w", F.lit("clash"))
    for literal in (op1_licenses.LITERAL, 0):
        got = {(r.doc_id, r.license) for r in op1_licenses.scan(docs, op1_licenses.templates(spark), literal=literal).collect()}
        assert got == {(i, x) for i in range(len(texts)) for x in ("BSD-3-Clause", "LicenseRef-all-rights-reserved")}


def brute_licenses(texts, threshold=0.8):
    """By exact containment of each template's shingles in stretches of the window's reach, at every word."""
    cut, out = lambda t: [w for w in re.split("[^a-z0-9]+", t.lower()) if w], set()
    for i, text in texts:
        doc = cut(text or "")
        for name, template in op1_licenses.TEMPLATES:
            t = cut(template)
            k = min(len(t), 5)
            want = {tuple(t[j : j + k]) for j in range(len(t) - k + 1)}
            grams = [tuple(doc[j : j + k]) for j in range(len(doc) - k + 1)]
            at = [j for j, g in enumerate(grams) if g in want]
            if any(len({grams[j] for j in at if a <= j < a + len(t)} & want) >= threshold * len(want) for a in at):
                out.add((i, name))
    return out


def test_licenses_by_containment(spark):
    rng, rows = random.Random(23), []
    for i in range(240):
        t = op1_licenses.TEMPLATES[i % len(op1_licenses.TEMPLATES)][1].split()
        for _ in range(i % 4):  # up to three words changed, lost or put in
            j = rng.randrange(len(t))
            t[j : j + 1] = rng.choice([["other"], [], [t[j], "more"]])
        rows.append((i, f"{words(rng.randint(0, 150), rng)} {' '.join(t)} {words(rng.randint(0, 150), rng)}"))
    got = {(r.doc_id, r.license) for r in op1_licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), op1_licenses.templates(spark)).collect()}
    assert got == brute_licenses(rows) and len(got) > 60


def test_ann(spark):
    rng = np.random.RandomState(1)
    x = rng.normal(size=(400, 16)).astype(np.float32)
    x[50] = x[0]
    x[51] = x[0]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(1000, None), (1050, [0.0] * 16), (1100, [float("nan")] * 16), (1150, [None] + [1.0] * 15), (1200, [1.0]), (None, [1.0] * 16)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    df, ask = op5_ann.usable(frame.withColumns({c: F.lit("clash") for c in ("x", "code", "key", "shard", "ask")})), F.col("vec_id") % 50 == 0
    got = op5_ann.nearest(df, ask, shard=150, block=3).collect()
    hit = 0
    for q in range(0, 400, 50):
        s = op5_ann.cosine(x[q].astype(float), x.astype(float))
        order = [i for i in np.lexsort((np.arange(400), -s)) if i != q][:5]
        mine = [r for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q]
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5] and all(r.score == s[r.vec_id] for r in mine)
        hit += len({r.vec_id for r in mine} & set(order))
    assert hit >= 0.9 * 40 and len(got) == 40
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 0][:2] == [50, 51]
    # a repeated row is a candidate for the first one, and a query of its own
    twice = op5_ann.nearest(op5_ann.usable(frame.unionByName(frame.where("vec_id = 100"))), ask).where("query_id = 100").collect()
    assert len(twice) == 10 and sorted(r.vec_id for r in twice if r["rank"] == 1) == [100, 100]
    few = df.where("vec_id < 3")
    assert op5_ann.nearest(few, ask).count() == 2
    assert op5_ann.nearest(df.limit(0), ask).count() == 0


def test_shard_index():
    rng = np.random.RandomState(0)
    codes = rng.randint(0, 256, (500, 8)).astype(np.uint8)
    codes[10:20] = codes[3]
    codes[15, 0] ^= 7
    index = op5_ann.ShardIndex(codes, 64)
    for r in (0, 3, 9, 15, 19):
        d = np.bitwise_count(codes ^ codes[3]).sum(1)
        assert set(index.within(codes[3], r, op5_ann.masks(r // index.m))) == set(np.flatnonzero(d <= r))


def test_range_coder():
    rng = np.random.RandomState(0)
    for ids in (np.zeros(0, int), np.array([65535]), rng.randint(0, 65536, 5000), rng.zipf(1.4, 9000) % 49408, np.zeros(4097, int), np.tile([1, 2, 3], 3000)):
        blocks = range_coder.encode(ids)
        assert (range_coder.decode(*blocks) == ids).all()
    prior, payload, length, sums = range_coder.encode(np.tile([1, 2, 3], 3000))
    assert sum(map(len, payload)) < 2000 and len(prior) < 100
    one = range_coder.decode(prior, payload[1:2], length[1:2], sums[1:2])
    assert len(one) == length[1] and one.tolist() == np.tile([1, 2, 3], 3000)[length[0] :][: len(one)].tolist()
    with pytest.raises(ValueError, match="checksum"):
        range_coder.decode(prior, [payload[1]], length[:1], [sums[0] ^ 1])


def test_carries_run_through_full_words():
    """A carry into a word of ones goes on to the words before it, in its own lane only."""
    rng = random.Random(9)
    words, want = range_coder._Words(3, 60), [0, 0, 0]
    first = np.array([5, 6, 7], np.uint64) << np.uint64(32)
    words.put(np.arange(3), first)
    want = [5, 6, 7]
    for _ in range(50):
        over = np.array([rng.random() < 0.3 for _ in want])
        words.carry(over)
        want = [w + int(o) for w, o in zip(want, over)]
        which = np.array([i for i in range(3) if rng.random() < 0.8], int)
        low = np.array([rng.choice([0xFFFFFFFF, 0xFFFFFFFF, 0, 1]) << 32 for _ in want], np.uint64)
        words.put(which, low)
        want = [(w << 32) + (int(low[i]) >> 32) if i in which else w for i, w in enumerate(want)]
    assert [int.from_bytes(words.of(i).astype(">u4").tobytes(), "big") for i in range(3)] == want


def test_range_coder_is_smaller():
    """On ids of a shared table: smaller than zlib and than a static order-0 code of the same ids."""
    import pyarrow.parquet as pq

    tokens = op6_token_files.Tokens(op2_bpe.vocabulary("word_bpe_49k.json"))
    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"])["text"].to_pylist()
    ids = np.frombuffer(b"".join(tokens.ids(texts)), "<u2")
    prior, payload, length, sums = range_coder.encode(ids)
    assert (range_coder.decode(prior, payload, length, sums) == ids).all()
    count = np.bincount(ids)
    share = count[count > 0] / len(ids)
    size = len(prior) + sum(map(len, payload))
    assert size < len(zlib.compress(ids.tobytes(), 9)) and size < -(share * np.log2(share)).sum() * len(ids) / 8


def test_words_as_the_library():
    rng = random.Random(31)
    tokens = op6_token_files.Tokens(op2_bpe.vocabulary("word_bpe_49k.json"), words=30)
    bits = ["a", "Straße", "don't", "'LL", "12", "É", "…", "日本", "<|endoftext|>", "İ", "x\u0301", "!!", "ﬁ", "\xa0", "\x1c", "Z", "ª", "º", "µ", "Σς", "²"]
    for _ in range(150):
        texts = ["".join(rng.choice([*bits, " ", " ", "\n"]) for _ in range(rng.choice([0, 3, 40]))) for _ in range(4)]
        assert tokens.ids(texts) == [np.array(tokens.tok.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]


def test_words_are_looked_up_once(monkeypatch):
    """Python sees each different word of a call once; blank, null and odd texts among others keep their places."""
    tokens, asked = op6_token_files.Tokens(op2_bpe.vocabulary("word_bpe_49k.json")), []
    find = tokens._find
    monkeypatch.setattr(tokens, "_find", lambda w: asked.append(w) or find(w))
    texts = [None, "", "  b a\tb ", "x\x1cy a", "\n", "é b a" * 50, "日本 b"]
    assert tokens.ids(texts) == [np.array(tokens.tok.encode(t or "", add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
    assert len(asked) == 1 and len(asked[0]) == len(set(asked[0])) and len(tokens.ids([None])) == 1 and tokens.ids([]) == []


def test_pieces_are_cut_outside_python(monkeypatch):
    """Python sees the different pieces of a call, not its words, and pieces are the library's own at apostrophes, digits, signs and other characters."""
    rng = random.Random(5)
    tokens, asked = op6_token_files.Tokens(op2_bpe.vocabulary("word_bpe_49k.json"), words=40), []
    find = tokens._find
    monkeypatch.setattr(tokens, "_find", lambda p: asked.append(p) or find(p))
    library = lambda texts: [np.array(tokens.tok.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
    texts = ["Ab, ab. aB! É7é (ab)", "don't É''s x×y, <|ab"]
    assert tokens.ids(texts) == library(texts)
    assert sorted(asked[0]) == sorted(["ab", ",", ".", "!", "é", "7", "(", ")", "don", "'t", "''", "s", "x×y,", "<|ab"])
    bits = ["'", "'", "s", "T", "re", "vE", "m", "ll", "l", "d", "a", "É", "ß", "Þ", "×", "÷", "7", "!", "-", "\x01", "\x7f", "<|", "|>", "<|endoftext|>", "β", "\u0301", "日", " ", " ", "\n", "\t"]
    for _ in range(600):
        texts = ["".join(rng.choices(bits, k=rng.choice([0, 1, 2, 5, 30]))) for _ in range(rng.choice([1, 3]))]
        assert tokens.ids(texts) == library(texts), texts


def test_token_files(spark, docs, empty, tmp_path):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(op2_bpe.vocabulary("word_bpe_49k.json"))
    op6_token_files.write_files(docs, f"file://{tmp_path}/a", segment=3000, parts=3)
    got = sorted(op6_token_files.read_files(spark, f"file://{tmp_path}/a").collect(), key=lambda r: r.start)
    start = 0
    assert [r.doc_id for r in got] == [None, *sorted([*range(len(TEXTS)), 7])]
    texts = dict(pairs())
    for r in got:
        ids = [*tok.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 1]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    op6_token_files.write_files(empty, f"file://{tmp_path}/b")
    assert op6_token_files.read_files(spark, f"file://{tmp_path}/b").count() == 0


PAGE = """<html><head><title>t</title><script>var a="<p>no</p>";</script></head><body><nav><ul><li>menu</li></ul></nav><!-- x <p>no --><div class="ad">buy</div>
<article><h1>Head &amp; more</h1><p><b>First  part<br><p>Second&nbsp;&#233;\n x <i>y</i>z</p><div class="comments"><p>troll</p></div><aside>side</aside></article><footer>&copy; f</footer></body></html>"""


def test_html(spark):
    rows = [(1, "http://a/1", PAGE), (1, "http://a/1", PAGE), (2, "http://a/2", None), (3, None, ""), (4, "http://a/4", "<p>cut <b>off</b> &am <a hre"), (5, "http://a/5", "just text")]
    common = "We value every visitor of this fine little site very much"
    rows += [(10 + i, f"http://h/{i}", f"<div>{common}</div><div>Story {words(30)}</div><div id='footer'>x</div>") for i in range(5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = op7_html.extract(df).collect()
    by = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and by[1] == "Head & more\nFirst part\nSecond é x yz" and by[2] == by[3] == ""
    assert by[4] == "cut off &am" and by[5] == "just text"
    assert all(by[10 + i].startswith("Story ") and "visitor" not in by[10 + i] for i in range(5))
    assert all(r.n_chars == len(r.text) for r in got) and op7_html.extract(df.limit(0)).count() == 0


def test_html_runs_decide_in_articles(spark):
    line = "Get our letter every day and never miss a story"
    copied = f"<article><h1>A copied story</h1><p>{words(40)}</p><p>{words(30)}</p></article>"
    rows = [(i, f"http://h/{i}", f"<article><h1>Title</h1><p>Story {i} {words(40)}</p><p>{line}</p><p>Yes.</p></article>") for i in range(4)]
    rows += [(10 + i, f"http://h/{10 + i}", copied) for i in range(3)]
    rows += [(20, "http://one/20", "<article><p>Only page of this host, in three rows of the table</p></article>")] * 3
    by = {r.page_id: r.text for r in op7_html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(line not in by[i] and by[i].startswith(f"Title\nStory {i} ") and by[i].endswith("\nYes.") for i in range(4))
    assert all(by[10 + i].count("\n") == 2 for i in range(3)) and by[20].startswith("Only page")


@pytest.mark.parametrize("part", [600, 1 << 20])
def test_html_evidence_of_the_whole_host(spark, part):
    line, rng = "Sign up today for the best of our weekly stories", random.Random(9)
    rows = [(i, f"http://big/{i}", f"<div>Story {i} {words(30, rng)}</div>" + (f"<div>{line}</div><div>So short</div>" if i % 20 == 0 else "") + (f"<div>{line} twice</div>" if i % 50 == 1 else "")) for i in range(100)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    by = {r.page_id: r.text for r in op7_html.extract(df, part).collect()}
    assert len(by) == 100 and all(t.startswith(f"Story {i} ") for i, t in by.items())
    assert not any("Sign up" in t or "So short" in t for t in by.values())


def test_html_articles_and_boilerplate(spark):
    body = f"<div class='body'><h1>A story</h1><p>Body {words(20)}</p></div>"
    pages = [
        body + "<div class='comments'><article>troll</article></div>",
        body + "<aside><article>teaser</article></aside>",
        "<article><header class='entry-header'><h1>The title</h1></header><section id='legal-history' aria-label='Legal notice'><p>Law</p></section><div class='related'>more</div><div class='comments-area'>troll</div></article>",
        "<article class='post long-form'><div class='side-by-side'>Both</div><div class='share-links'>send</div></article>",
    ]
    df = spark.createDataFrame([(i, f"http://h{i}/", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    by = {r.page_id: r.text for r in op7_html.extract(df).collect()}
    assert all(by[i].startswith("A story\nBody ") and "troll" not in by[i] and "teaser" not in by[i] for i in (0, 1))
    assert by[2] == "The title\nLaw" and by[3] == "Both"


def brute_texts(rows, run=op7_html.RUN, most=op7_html.PAGES):
    """What is left of each page when every run of tokens on so many pages of its host is sought by plain counting."""
    parsed = []
    for page_id, url, page in rows:
        found = op7_html.blocks(page)
        art = op7_html.article(found)
        parsed.append(((url.split("/")[2], page_id, url), found, art, [t.split(" ") for t, *_ in found]))
    on, whole = {}, {}
    for (host, *page), _, _, stream in parsed:
        for b in stream:
            for i in range(len(b) - run + 1):
                on.setdefault((host, tuple(b[i : i + run])), set()).add(tuple(page))
            whole.setdefault((host, tuple(b)), set()).add(tuple(page))
    out = []
    for (host, page_id, _), found, art, stream in parsed:
        left, all_gone = [], []
        for b in stream:
            gone = [False] * len(b)
            for i in range(len(b) - run + 1):
                if len(on[host, tuple(b[i : i + run])]) >= most:
                    gone[i : i + run] = [True] * run
            rest = [t for t, g in zip(b, gone) if not g]
            if len(b) < run:
                rest = [] if len(whole[host, tuple(b)]) >= most else b
            elif any(gone) and len(rest) < run:
                rest = []
            left.append(" ".join(rest))
            all_gone.append(all(gone))
        if art is None:
            out.append((page_id, "\n".join(x for x, (_, _, bad, _) in zip(left, found) if x and not bad)))
            continue
        gone = {i for i in art if all_gone[i] and not found[i][3]}
        if 2 * sum(len(stream[i]) for i in gone) > sum(len(stream[i]) for i in art):
            gone = set()
        out.append((page_id, "\n".join(found[i][0] for i in art if i not in gone)))
    return sorted(out)


@pytest.mark.parametrize("part", [2_000, 1 << 20])
def test_html_against_plain_counting(spark, part):
    rng = random.Random(41)
    lines = [words(rng.randint(2, 14), rng) for _ in range(12)]
    rows = []
    for i in range(60):
        blocks = [rng.choice(lines) if rng.random() < 0.4 else words(rng.randint(1, 25), rng) + (" " + rng.choice(lines) if rng.random() < 0.3 else "") for _ in range(rng.randint(1, 7))]
        inner = "".join(f"<p>{b}</p>" for b in blocks)
        page = f"<article><h1>{rng.choice(lines)}</h1>{inner}</article><footer>{lines[0]}</footer>" if i % 2 else f"<nav>{lines[1]}</nav><div>{inner}</div>"
        rows.append((i, f"http://h{i % 3 if i % 5 else 0}/{i}", page))
    rows += rows[:4]  # repeated rows are one page
    got = op7_html.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), part).collect()
    want = brute_texts(rows)
    assert sorted((r.page_id, r.text) for r in got) == want
    assert want != sorted((i, "\n".join(t for t, *_ in op7_html.blocks(p))) for i, _, p in rows)


def test_html_keys():
    rng = np.random.RandomState(3)
    keys = np.unique(rng.randint(0, 1 << op7_html.KEY_BITS, 5000).astype(np.uint64))
    got, n = op7_html.unpack(op7_html.pack(keys, np.arange(len(keys)) % 4))
    assert (got == keys).all() and (n == np.arange(len(keys)) % 4).all()


def test_url_filter(spark):
    urls = [None, "", "nothing", "http://EXAMPLE.org/es/1", "https://a.b.example.org/en/17?x#y", "http://x.com/fr/", "http://x.com/de/a", "http://x.com/it/", "ftp://notexample.org/es/", "http://org", "http://org/", "http://x.net/fr/", "http://example.org?/es/", "://com/fr/", "http://a..com/de/x"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate([*urls, urls[3]])], "page_id long, url string").withColumn("host", F.lit("clash"))
    rules = spark.createDataFrame(op8_url_filter.RULES, "host string, path string, verdict string")
    df.unionByName(df.where("page_id = 3")).createOrReplaceTempView("pages")
    got = op8_url_filter.url_verdicts(spark.table("pages"), rules).collect()

    def brute(u):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        m = re.match(r"([^/?#]*)([^?#]*)", rest)
        host, path = m[1].translate({c: c + 32 for c in range(65, 91)}), m[2]
        fit = [(len(h + p), h + p, v) for h, p, v in op8_url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, *(max(fit)[1:] if fit else (None, "allow")))

    want = [(i, *brute(u)) for i, u in [*enumerate([*urls, urls[3]]), (3, urls[3])]]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert op8_url_filter.url_verdicts(spark.table("pages").limit(0), rules).count() == 0
    assert op8_url_filter.url_verdicts(spark.table("pages"), rules.limit(0)).where("verdict = 'allow'").count() == len(want)


def test_toxicity(spark, docs, empty):
    rng, bad = random.Random(1), ["gruk", "vlort", "zmeek"]
    rows = []
    for i in range(900):
        toxic = rng.random() < 0.2
        rows.append((i, words(40, rng) + (" you " + rng.choice(bad) + " " if toxic else " you ") + words(20, rng), int(toxic)))
    df = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(5000, None), (5001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0, y) for i, _, y in rows] + [(5000, 0, 0), (7000, 1, 1), (None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in op10_toxicity.toxicity(df, labels).collect()}
    assert len(got) == 902 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got)
    assert np.mean([got[i].predicted == y for i, _, y in rows if got[i].held_out]) > 0.97
    assert got[5000].predicted == 0 and op10_toxicity.toxicity(empty, labels).count() == 0
    assert op10_toxicity.toxicity(df, labels.limit(0)).where("score > 0").count() == 0


def test_toxicity_features():
    """Each feature against its plain definition; long unbroken runs take no longer than other texts."""
    f = op10_toxicity.Featurizer({"gruk": 3.0, "vlor-": 2.6, "meh": 1.0, "fool": 4.0})
    text = "You GRUK!! vlorting meh, is F00L sooo f@@l? a.b.c.d x"
    row = dict(zip(op10_toxicity.FEATURES, f.row(text)))
    words_ = ["you", "gruk", "vlorting", "meh", "is", "f00l", "sooo", "f", "l", "a", "b", "c", "d", "x"]
    assert row["log_words"] == np.log1p(len(words_))
    # gruk, vlorting, f00l as fool, and once more each for the masked F00L and f@@l
    assert row["strong_rate"] * len(words_) == pytest.approx(row["masked_hits"] + 3) and row["weight_max"] == 4.0 and row["mild_rate"] == 1 / len(words_)
    assert row["second_rate"] == 1 / len(words_) and row["near_second"] > 0 and row["strong_any"] == 1
    assert row["capital_rate"] == sum(c.isupper() for c in text) / len(text) and row["exclaim_rate"] == 2 / len(words_) and row["question_rate"] == 1 / len(words_)
    assert row["digit_rate"] == 2 / len(text) and row["stretch_rate"] == 1 / len(words_) and row["punct_rate"] == sum(c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" for c in text) / len(text)
    assert f.row(None) == f.row("") == f.row(" \n") == [0.0] * len(op10_toxicity.FEATURES)
    import time

    began = time.process_time()
    for long in ("z" * 2_000_000, "ab@" * 300_000, "a " * 500_000, "A" * 1_000_000, "a.a." * 200_000):
        assert len(f.row(long)) == len(op10_toxicity.FEATURES)
    assert time.process_time() - began < 60


def test_toxicity_shortcuts():
    rng = random.Random(19)
    for _ in range(4000):
        t = "".join(rng.choice("abAé  ..-*_@$!01ßzZ\U0001d41a日") for _ in range(rng.choice([0, 1, 2, 8, 40])))
        found = op10_toxicity._WORD.findall(t.lower())
        assert op10_toxicity.masked_words(t, found) == op10_toxicity._MASKED.findall(t) and op10_toxicity.stretches(t) == len(op10_toxicity._STRETCH.findall(t))


def test_toxicity_trees():
    """The first split is the best of all by exhaustive search, and scores are sums of the leaves that rows fall into."""
    rng = np.random.RandomState(6)
    x = rng.normal(size=(300, 4)).round(1)
    y = ((x[:, 1] > 0.3) ^ (rng.uniform(size=300) < 0.1)).astype(float)
    trees = op10_toxicity.Trees(rounds=5, depth=2).fit(x, y)
    p = y.mean()
    g, h = y - p, np.full(len(y), p * (1 - p))
    best = (-1.0, None, None)
    for j in range(4):
        for e in range(len(trees.edges[j])):
            left = np.searchsorted(trees.edges[j], x[:, j], side="left") <= e
            if min(left.sum(), (~left).sum()) >= trees.least:
                gain = g[left].sum() ** 2 / (h[left].sum() + 1) + g[~left].sum() ** 2 / (h[~left].sum() + 1) - g.sum() ** 2 / (h.sum() + 1)
                if gain > best[0] + 1e-12:
                    best = (gain, j, e)
    assert trees.trees[0][0][:3] == (0, best[1], best[2])
    for row, score in zip(x[:50], trees.raw(x[:50])):
        total = trees.base
        for tree in trees.trees:
            nodes, k = {t[0]: t for t in tree}, 0
            while nodes[k][1] >= 0:
                k = 2 * k + 1 + int(np.searchsorted(trees.edges[nodes[k][1]], row[nodes[k][1]], side="left") > nodes[k][2])
            total += nodes[k][3]
        assert score == pytest.approx(total)


def test_toxicity_sample_is_exact(spark):
    rng = random.Random(8)
    rows = [(i, words(10, rng) + (" gruk you" if i % 4 == 0 else "")) for i in range(400)]
    docs = spark.createDataFrame([*rows, *rows[:50], (3, "another text")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0, int(i % 4 == 0)) for i in range(400)], "doc_id long, quality int, toxic int").withColumns({"text": F.lit("clash"), "fold": F.lit(9)})
    one = op10_toxicity.train(docs.repartition(7), labels, sample=150)
    two = op10_toxicity.train(docs.orderBy(F.desc("text")), labels.repartition(3), sample=150)
    texts = [t for _, t in rows]
    assert one.features.lexicon == two.features.lexicon and (one.score(texts) == two.score(texts)).all()


def test_isotonic():
    px, py = op10_toxicity.isotonic(np.array([1.0, 2, 2, 3, 4]), np.array([0.0, 1, 0, 0, 1]))
    assert list(np.interp([1, 2, 3, 4], px, py)) == [0, 1 / 3, 1 / 3, 1] and (np.diff(py) >= 0).all()


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(4)
    base = [words(120, rng) for _ in range(60)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(base)] + [(100, base[0], "en", "s", 1), (101, words(40, rng) + " " + base[1][:400] + " " + words(40, rng), "en", "s", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, base[5])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert 100 not in got and 5 not in got and 101 in got and len(got) == 60


def test_pipeline_of_untidy_rows(spark, tmp_path):
    """Null and repeated ids, empty and blank texts, repeated rows, clashing columns; then no rows at all."""
    import corpus_pipeline
    from provlake.llm import common

    rng = random.Random(14)
    texts = [words(90, rng) for _ in range(8)]
    rows = [(None, texts[0]), (None, texts[1]), (5, texts[2]), (5, texts[3]), (6, None), (7, ""), (8, "  \n"), (9, texts[4]), (9, texts[4]), (None, texts[5]), (None, texts[5]), (10, texts[6] + " " + "w" * 50_000)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "a", "b", "c") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, fp string, spans string, row_key string")
    docs.write.parquet(f"{tmp_path}/a/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/b/documents.parquet")
    for d in "ab":
        spark.createDataFrame([(1, texts[1])], "item_id long, text string").write.parquet(f"{tmp_path}/{d}/benchmark.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{d}/labels.parquet")
    before = common.written()
    got = corpus_pipeline.run(spark, f"{tmp_path}/a").collect()
    # one row of the empty texts, one of each repeated row; the benchmark's text goes
    assert sorted(r.decoded for r in got) == sorted(["", texts[0], texts[2], texts[3], texts[4], texts[5], rows[-1][1]])
    assert all(len(r.ids) == r.n_tokens for r in got) and common.written() == before + 1
    assert corpus_pipeline.run(spark, f"{tmp_path}/b").count() == 0
    docs_ = spark.read.parquet(f"{tmp_path}/a/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs_, f"{tmp_path}/a").columns == docs_.columns


def test_stages_tell_rows_apart(spark, tmp_path):
    rng = random.Random(12)
    a, b, c, d, e = (words(80, rng) for _ in range(5))
    docs = spark.createDataFrame([(None, a, 0), (1, b, 1), (1, c, 2), (2, c, 3), (None, d, 4), (None, d, 5), (3, d, 6), (None, e, 7), (None, e, 8)], "doc_id long, text string, row int")
    kept = [r.row for r in op4_simhash.stage(spark, docs, str(tmp_path)).collect()]
    assert sorted(x if x < 7 else 7 for x in kept) == [0, 1, 2, 6, 7] and op4_simhash.stage(spark, docs, str(tmp_path)).columns == docs.columns
    spark.createDataFrame([(1, a), (2, c)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert sorted(r.row for r in op9_decontaminate.stage(spark, docs, str(tmp_path)).collect()) == [1, 4, 5, 6, 7, 8]


def test_bpe_stage(spark, docs):
    full = sorted(op2_bpe.stage(spark, docs, "").collect(), key=lambda r: str(r.doc_id))
    digest = sorted(op2_bpe.encode(docs, output="digest").collect(), key=lambda r: str(r.doc_id))
    assert [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in full] == [tuple(r) for r in digest]
    assert all(len(r.ids) == r.n_tokens for r in full) and any(r.decoded == PASSAGE for r in full)
