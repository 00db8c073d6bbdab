"""Each operator against a plain version, and on awkward tables."""

from __future__ import annotations

import gc
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rangelake.llm import attention, automaton, decontamination, encoder, exact_dedup, exponentials, language_id, language_model, near_duplicates, packing, pii, secret_scan, simple8b, token_output, url_filter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, row int, part int, id string, key int, score double, kept boolean"
WORDS = [f"{a}{b}" for a in ("ba", "do", "ke", "li", "mu", "na") for b in ("ter", "sol", "vin", "ram", "pek")]


def frame(spark, texts, langs=None, ids=None):
    rows = [(i if ids is None else ids[i], t, langs[i] if langs else None, None, None, "x", 1, 2, "y", 3, 0.5, None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def prose(seed, n, words=WORDS):
    r = np.random.default_rng(seed)
    return " ".join(words[i] for i in r.integers(0, len(words), n))


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing names."""
    texts = [None, "", " \t\n", "...", "a", "A b", "a  b", "a\nb", prose(1, 9000), prose(1, 9000), prose(2, 60), prose(2, 60), "é" * 3000, "x" * 70000]
    df = frame(spark, texts, ["en", None] * 7)
    return df.unionByName(frame(spark, ["orphan", None], ids=[None, None])).unionByName(df.limit(12).filter("doc_id > 9"))


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


# 1 exact dedup


def test_exact_dedup(spark, awkward, nothing):
    got = {(r["doc_id"], r["text_sha256"]): r for r in exact_dedup.exact_dedup(awkward, k=2).collect()}
    groups = defaultdict(list)
    for r in awkward.select("doc_id", "text").collect():
        groups[hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "").encode()).hexdigest()].append(r["doc_id"])
    for digest, ids in groups.items():
        known = [i for i in ids if i is not None]
        for i in ids:
            r = got[i, digest]
            assert (r["keep_id"], r["group_size"], r["kept"]) == (min(known, default=None), len(ids), bool(known) and i == min(known))
    assert exact_dedup.exact_dedup(awkward).count() == awkward.count() and exact_dedup.exact_dedup(nothing).count() == 0


def test_drop_duplicates_keeps_one_row_of_each_text(spark, awkward, nothing):
    """Also where an id stands at several texts, rows repeat, or ids are null."""
    texts = ["same", "same", "another", "another one", "rep", "rep", "n  n", "n n", "x", "x"]
    docs = frame(spark, texts, ids=[3, 5, 5, 5, 7, 7, None, None, None, 9]).unionByName(awkward.withColumn("doc_id", F.col("doc_id") + 100)).repartition(5)
    left = exact_dedup.drop_duplicates(docs, k=2)
    groups = defaultdict(list)
    for r in docs.collect():
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "")].append(r["doc_id"])
    first = lambda ids: min((i for i in ids if i is not None), default=None)
    got = Counter((r["doc_id"], re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "")) for r in left.collect())
    assert left.columns == docs.columns and got == Counter((first(ids), t) for t, ids in groups.items())
    assert exact_dedup.drop_duplicates(nothing).count() == 0


def test_heavy_digests_are_found(spark):
    r = np.random.default_rng(0)
    digests = [b"hot"] * 400 + [bytes([i % 256, i // 256]) for i in range(500)]
    df = spark.createDataFrame([(digests[i],) for i in r.permutation(900)], "digest binary").repartition(5)
    assert b"hot" in exact_dedup.frequent(df, 3)


# 2 URL filter


def plain_rule(url):
    rules = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host) :])[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = []
    for rule in rules:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append(rule)
    return host, path, max(fits, key=len, default=None)


def test_url_rules(spark):
    urls = [None, "", "x", "http://", "HTTP://A.Example.NET/en/1?q#f", "http://example.net/de/", "http://net", "http://net/", "http://xnet/", "http://a.org/fr/x", "http://a.org/FR/x", "http://example.com/de/?a=b", "http://example.com?x=/de/", "a://b://c/d", "http://ÄÖ.org/fr/\n"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for r in url_filter.url_filter(pages, labels).collect():
        host, path, rule = plain_rule(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == ("allow" if rule is None or rule in ("example.net/en/", "org/fr/") else "block")


@pytest.mark.parametrize("joined", [False, True])
def test_url_rules_are_learned(spark, tmp_path, monkeypatch, joined):
    """Mined rules equal those of counting all combinations, and a page is blocked if one fits."""
    r = np.random.default_rng(3)
    urls, labels = [], []
    for i in range(600):
        bad_host, bad_path = r.random() < 0.4, r.random() < 0.4
        urls.append(f"http://{'casino' if bad_host else 'news'}{r.integers(3)}.site.org/{'win' if bad_path else 'read'}/{i}?{'ref' if r.random() < 0.5 else 'page'}=1")
        labels.append((i, 1, int((bad_host and bad_path) != (r.random() < 0.05))))
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    tokens = {x["page_id"]: frozenset(x["t"]) for x in pages.select("page_id", url_filter.tokens_of(F.col("url")).alias("t")).collect()}
    counts, blocked = Counter(), Counter()
    for i, _, toxic in labels:
        have = sorted(tokens[i])
        for mask in range(1, 1 << len(have)):
            part = frozenset(t for k, t in enumerate(have) if mask >> k & 1)
            counts[part] += 1
            blocked[part] += toxic
    base, z = sum(t for _, _, t in labels) / len(labels), url_filter.Z

    def low(p, n):
        return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)

    rules = {p: n / counts[p] for p, n in blocked.items() if n >= 0.005 * 600 and n / counts[p] >= 1.5 * base and low(n / counts[p], counts[p]) > base}
    expected = {i: "block" if any(p <= t for p in rules) else "allow" for i, t in tokens.items()}
    monkeypatch.setattr(url_filter, "BROADCAST", 0 if joined else 10**6)
    got = {x["page_id"]: x["verdict"] for x in url_filter.url_filter(pages, labelled).collect()}
    assert got == expected and set(got.values()) == {"allow", "block"}
    mined = {frozenset(r["tokens"]): r for r in url_filter.mine(pages, labelled, f"file://{tmp_path}/m").collect()}
    assert mined.keys() == {p for p, c in rules.items() if not any(o < p and rules[o] >= c for o in rules)}
    assert all(counts[frozenset([r["rarest"]])] == min(counts[frozenset([t])] for t in p) for p, r in mined.items())


def test_url_filter_of_awkward_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c", "x", 0.5), (1, "http://a.b/c", None, None), (None, None, None, None)], "page_id long, url string, tokens string, confidence double")
    labels = spark.createDataFrame([(1, None, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    assert [r["verdict"] for r in url_filter.url_filter(pages, labels).collect()] == ["allow"] * 3
    assert url_filter.url_filter(pages.limit(0), labels).count() == 0


# 3 token output


@pytest.mark.parametrize("values", [[], [0] * 3000, [2**64 - 1] * 2500, [2**60 - 1, 2**60 - 2, 2**60, 5], list(range(5000)), [1, 0] * 700 + [2**33] * 9 + [7] * 900])
def test_simple8b(values):
    v = np.array(values, dtype=np.uint64)
    segment = simple8b.encode(v)
    assert (simple8b.decode(segment) == v).all() and len(simple8b.decode(segment)) == len(v)
    blocks = -(-len(v) // simple8b.BLOCK)
    assert blocks == 0 or (np.concatenate([simple8b.decode_block(segment, k) for k in range(blocks)]) == v).all()


def test_simple8b_words_are_full():
    v = np.random.default_rng(0).integers(0, 1 << 15, 4096).astype(np.uint64) | np.uint64(1 << 14)
    assert len(simple8b.encode(v)) < 8 * 4096 / 4 + 100  # four values of 15 bits a word
    with pytest.raises(ValueError):
        simple8b.decode(b"x" * 40)


def library_ids(name, texts):
    t = encoder.encoder(name).tokenizer
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_the_library(name):
    r = np.random.default_rng(5)
    bits = ["a", "B", "Ka", " ", " ", "  ", "\n", "\t", "'s", "é", "1", "!", ",", "<|endoftext|>", "\u3000", "\x1c", "\x01", "Σ", "ñ", "İ", "\u0301", "日本", "😀"]
    texts = ["".join(r.choice(bits, size=r.integers(0, 30))) for _ in range(1500)] + ["", " ", "x ", prose(3, 500)]
    assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encoder(name).encode(texts)] == library_ids(name, texts)


def test_encoder_forgets_without_harm():
    own = encoder.encoder("byte_bpe_50k.json", 10)
    texts = [prose(i, 30) for i in range(20)]
    for lo in range(0, 20, 5):
        assert [np.frombuffer(b, "<u4").tolist() for b in own.encode(texts[lo : lo + 5])] == library_ids("byte_bpe_50k.json", texts[lo : lo + 5])


def test_words_are_learned_without_looking_for_cycles():
    """The collector rests while new words are encoded, also if that fails, and is as before afterwards."""
    import public_tokenizers

    name = "byte_bpe_50k.json"
    own = encoder.Encoder(public_tokenizers.path(name))
    plain, enabled = own._words, []
    own._words = lambda words: (enabled.append(gc.isenabled()), plain(words))[1]
    texts = ["x the, the \u00dcn\u00ef. Stra\u00dfe! a.b, 12, ?", "x , .. \u00e9:"]
    assert [np.frombuffer(b, "<u4").tolist() for b in own.encode(texts)] == library_ids(name, texts)
    assert enabled == [False] and gc.isenabled()
    own._words = lambda words: 1 / 0
    with pytest.raises(ZeroDivisionError):
        own.encode(["x unmet"])
    assert gc.isenabled()


def test_token_output(spark, awkward, nothing, tmp_path, monkeypatch):
    monkeypatch.setattr(token_output, "SEGMENT", 2000)
    token_output.write_tokens(awkward, f"file://{tmp_path}/t")
    got = token_output.read_tokens(spark, f"file://{tmp_path}/t", with_ids=True).orderBy("start").collect()
    rows = sorted(awkward.select("doc_id", "text").collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] is not None, r["text"] or ""))
    at = 0
    for r, row, ids in zip(got, rows, library_ids(token_output.VOCABULARY, [r["text"] or "" for r in rows]), strict=True):
        ids = [*ids, 0]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids"]) == (row["doc_id"], at, len(ids), ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert token_output.token_output(nothing).count() == 0


# 4 decontamination

ITEMS = [(1, "Which of the seven rivers bends twice before it meets the northern sea? The long grey river does."), (2, "Name the metal that melts in a warm hand. Gallium is that metal."), (3, "yes no"), (4, None), (5, " ".join(WORDS[:28]))]


def test_decontamination(spark, awkward, nothing):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    filler = prose(8, 200)
    texts = {
        100: f"{filler} {ITEMS[0][1]} {filler}",
        101: f"{filler}. {ITEMS[1][1].upper()}",
        102: ITEMS[0][1].split("?")[0] + " " + filler,  # a question without its answer
        103: filler + " yes no " + filler,
        104: " ".join(reversed(ITEMS[0][1].split())),
        105: ("z" * 9 + " ") * 150_000 + ITEMS[1][1],
        106: ITEMS[0][1] + "\n" + ITEMS[1][1],
    }
    docs = frame(spark, list(texts.values()), ids=list(texts)).unionByName(awkward)
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.find_leaks(docs, benchmark).collect()}
    assert got == {(100, 1), (101, 2), (103, 3), (105, 2), (106, 1), (106, 2)}
    clean = decontamination.clean_documents(docs, benchmark)
    assert clean.columns == docs.columns and {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in docs.collect()} - {100, 101, 103, 105, 106}
    assert decontamination.find_leaks(nothing, benchmark).count() == 0 and decontamination.find_leaks(docs, benchmark.limit(0)).count() == 0


def test_block_max_wand_retrieves_all_above():
    r = np.random.default_rng(1)
    index = decontamination.Index([(i, prose(100 + i, int(r.integers(5, 40)), WORDS + [f"w{k}" for k in range(300)])) for i in range(150)])
    for _ in range(150):
        terms = sorted(set(r.choice(len(index.terms), 40).tolist()))
        scores = defaultdict(float)
        for t in terms:
            for i, x in zip(index.postings[t], index.impacts[t], strict=True):
                scores[i] += x
        for bound in (0.1, 0.3, 0.6):
            got = dict(index.retrieve(terms, bound))
            assert {i for i, s in scores.items() if s >= bound + 1e-9} <= set(got) <= {i for i, s in scores.items() if s >= bound - 1e-9}


def test_index_is_sharded_without_loss(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "INDEX_CHARS", 60)
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = frame(spark, [ITEMS[0][1], ITEMS[1][1]])
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.find_leaks(docs, benchmark).collect()} == {(0, 1), (1, 2)}


def test_short_items_are_found_as_phrases(spark):
    """Items of fewer than LEAST words, also without an id, and with those of others in other orders."""
    benchmark = spark.createDataFrame([(1, "red green blue"), (None, "Why? Because."), (7, "  "), (8, None)], "item_id long, text string")
    docs = frame(spark, ["a red, green BLUE sky", "green red blue green blue red", "why because", "red green", "because why", None, ""])
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.find_leaks(docs, benchmark).collect()} == {(0, 1), (2, None)}


def test_decontamination_equals_a_plain_version(spark):
    """Every passage against every item, scored term by term."""
    r = np.random.default_rng(5)
    items = [(i, prose(300 + i, int(r.integers(2, 30)), WORDS + [f"w{k}" for k in range(60)])) for i in range(40)]
    texts = [prose(400 + i, int(r.integers(1, 300))) for i in range(30)]
    for i in range(25):  # copies, some in part, some with a change
        words = items[int(r.integers(40))][1].split()
        words = words[int(r.integers(0, 3)) :]
        if i % 3 == 0:
            words[len(words) // 2] = "changed"
        at = int(r.integers(len(texts[i]) + 1))
        texts[i] = f"{texts[i][:at]} {' '.join(words)} {texts[i][at:]}"
    split = [(i, decontamination.words_of(t)) for i, t in items]
    average, longest = sum(len(w) for _, w in split) / len(split), max(len(w) for _, w in split)
    found_in = Counter(t for _, w in split for t in set(w))
    expected = set()
    for d, text in enumerate(texts):
        words = decontamination.words_of(text)
        for begin in range(0, longest * max(1, -(-len(words) // longest) - 1), longest):
            passage = words[begin : begin + 2 * longest]
            for (i, w), (_, raw) in zip(split, items, strict=True):
                tf = Counter(w)
                own = {t: math.log(1 + (40 - found_in[t] + 0.5) / (found_in[t] + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(w) / average)) for t, n in tf.items()}
                score = sum(x for t, x in own.items() if t in passage) / sum(own.values())
                q, a = decontamination.overlaps(decontamination.split_answer(raw), passage)
                if score >= 0.6 and q >= 0.6 and a >= 0.6:
                    expected.add((d, i))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.find_leaks(frame(spark, texts), benchmark).collect()}
    assert got == expected and len(got) >= 12


def test_scores_do_not_depend_on_shards(spark, monkeypatch):
    """An item in part scores the same in one index and in many."""
    items = [(i, prose(200 + i, 12 + i, WORDS[: 5 + i])) for i in range(12)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(spark, [" ".join(t.split()[k:]) for _, t in items for k in (0, 2)])
    report = lambda: {(r["doc_id"], r["item_id"]): round(r["score"], 6) for r in decontamination.find_leaks(docs, benchmark, 0.3, 0.3).collect()}
    whole = report()
    for size in (400, 60):
        monkeypatch.setattr(decontamination, "INDEX_CHARS", size)
        assert len(whole) >= 12 and report() == whole


def test_items_without_spaces_are_found(spark):
    items = [(1, "中国的首都是哪个城市？北京是中国的首都"), (2, "ประเทศไทยมีเมืองหลวงชื่ออะไร? กรุงเทพมหานคร")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(spark, [prose(1, 50) + items[0][1] + prose(2, 50), "今天" + items[1][1], "今天天气很好我们去公园散步吧", "我" * (decontamination.CHUNK + 5) + items[0][1]])
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.find_leaks(docs, benchmark).collect()} == {(0, 1), (1, 2), (3, 1)}
    assert decontamination.words_of("Ab_1 cd-é 北京ab") == ["ab_1", "cd", "é", "北", "京", "ab"]


# 5 language ID


def test_kernel_equals_plain_counting():
    texts = ["abc abd", "xyz xy", "abx"]
    model = language_id.fit([("p", texts[0]), ("q", texts[1])])
    grams = lambda t: {re.sub("[^a-z]", " ", t)[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    known = grams(texts[0]) | grams(texts[1])
    for t, row in zip(texts, model.kernel(texts), strict=True):
        own = grams(t) & known
        assert np.allclose(row, [len(own & grams(m)) / math.sqrt(len(own) * len(grams(m))) for m in texts[:2]], atol=1e-6)


def test_language_id(spark, awkward, nothing):
    other = ["".join(reversed(w)) for w in WORDS]
    texts = [prose(i, 40, WORDS if i % 2 else other) for i in range(240)]
    docs = frame(spark, texts, ["xx" if i % 2 else "yy" for i in range(240)])
    got = language_id.identify(docs).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == ("xx" if r["doc_id"] % 2 else "yy") for r in held) >= 0.95 * len(held)
    mixed = language_id.identify(docs.unionByName(awkward.withColumn("doc_id", F.col("doc_id") + 1000)))
    named = {r["doc_id"]: r["lang_pred"] for r in mixed.collect()}
    assert all(named[i] == "und" for i in (1000, 1001, 1002, 1003)) and named[1008] == "xx"
    assert {r["lang_pred"] for r in language_id.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language_id.identify(nothing).count() == 0 and language_id.known_language(docs).count() == 240


def test_languages_of_many_letters_are_told_apart(spark):
    """Two with the same 400 Chinese characters, one of them half in kana, and two of Indic scripts."""
    r = np.random.default_rng(4)
    pools = {"zh": range(0x4E00, 0x4E00 + 400), "ja": [*range(0x4E00, 0x4E00 + 400), *[*range(0x3042, 0x3090)] * 5], "hi": range(0x0915, 0x0939), "ta": [0x0B95, *range(0x0BAE, 0x0BBA)]}
    texts = [("".join(chr(c) for c in r.choice(list(pools[lang]), 60)), lang) for _ in range(60) for lang in pools]
    docs = frame(spark, [t for t, _ in texts], [lang for _, lang in texts])
    held = [(x["lang_pred"], texts[x["doc_id"]][1]) for x in language_id.identify(docs).collect() if x["held_out"]]
    assert len(held) > 50 and sum(a == b for a, b in held) >= 0.95 * len(held)


def test_language_id_equals_a_plain_kernel_ridge_regression():
    """Nystroem features with all texts as landmarks are kernel ridge regression itself."""
    sample = [(f"l{i % 3}", prose(500 + i, 12, [w[i % 3 :] for w in WORDS])) for i in range(30)]
    model = language_id.fit(sample)
    grams = lambda t: {re.sub("[^a-z]", " ", t)[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    sets = [grams(t) for _, t in sample]
    kernel = lambda a, b: len(a & b) / math.sqrt(len(a) * len(b))
    gram = np.array([[kernel(a, b) for b in sets] for a in sets])
    y = np.array([[1.0 if lang == x else -1.0 for x in model.languages] for lang, _ in sample])
    alpha = np.linalg.solve(gram + language_id.RIDGE * np.eye(30), y)
    for _, t in [*sample[:5], ("", prose(999, 20))]:
        own = grams(t) & set().union(*sets)
        decisions = np.array([kernel(own, s) for s in sets]) @ alpha
        names, scores = model.predict([t])
        assert names[0] == model.languages[decisions.argmax()] and abs(scores[0] - np.clip((decisions.max() + 1) / 2, 0, 1)) < 1e-3


def test_held_out_rows_teach_nothing(spark):
    docs = frame(spark, [prose(i, 40) for i in range(60)], ["xx"] * 60)
    poisoned = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, "zz").otherwise(F.col("lang")))
    assert {r["lang_pred"] for r in language_id.identify(poisoned).collect()} == {"xx"}


def test_foreign_texts_are_dropped(spark):
    other = ["".join(reversed(w)) for w in WORDS]
    own = [prose(i, 40, WORDS if i % 2 else other) for i in range(240)] + ["bater", "ba"]
    junk = "".join(np.random.default_rng(0).choice(list("abcdefghijklmnopqrstuvwxyz"), 400))
    foreign = ["Привет мир, как дела сегодня утром в городе", "今天天气很好我们去公园散步吧", junk, "Wszystkie ludzie rodzą się wolni i równi", own[0][:10] + junk]
    docs = frame(spark, own + foreign, ["xx" if i % 2 else "yy" for i in range(240)] + [None] * 7)
    assert {r["doc_id"] for r in language_id.known_language(docs).collect()} == set(range(242))


# 6 packing


@pytest.mark.parametrize("seed", range(30))
def test_plan(seed):
    r = np.random.default_rng(seed)
    cap = int(r.choice([10, 100, 2048]))
    lengths = r.integers(1, cap + 1, 300) if seed % 2 else np.minimum(r.geometric(0.02, 300), cap)
    histogram = dict(zip(*[x.tolist() for x in np.unique(lengths, return_counts=True)], strict=True))
    runs = np.array(packing.plan(histogram, cap))
    sequences = defaultdict(list)
    for length, n in histogram.items():
        own = runs[runs[:, 0] == length]
        for rank in range(n):
            run = own[np.searchsorted(own[:, 1], rank, side="right") - 1]
            since = rank - run[1]
            sequences[run[2] + since // run[3]].append((run[4] + since % run[3] * length, length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= cap and sum(3 * n > cap for _, n in pieces) <= 2
    rooms = []
    for n in sorted(lengths.tolist(), reverse=True):  # best fit, longest first, one by one
        fits = [x for x in rooms if x >= n]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else cap) - n)
    assert len(sequences) <= len(rooms) + 2


def test_packing(spark, awkward, nothing):
    got = packing.best_fit_pack(awkward, capacity=64).collect()
    ids = Counter()
    for r, e in zip(awkward.collect(), library_ids(packing.VOCABULARY, [r["text"] or "" for r in awkward.collect()]), strict=True):
        e = [*e, 0]
        for k in range(0, len(e), 64):
            ids[r["doc_id"], k // 64, k, len(e[k : k + 64]), zlib.crc32(np.array(e[k : k + 64], "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == ids
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in by.values():
        assert [o for o, _ in sorted(pieces)] == np.cumsum([0] + [n for _, n in sorted(pieces)])[:-1].tolist() and sum(n for _, n in pieces) <= 64
    assert packing.best_fit_pack(nothing).count() == 0


# 7 n-gram Jaccard join


def plain_links(rows):
    sets = []
    for _, t in rows:
        w = re.findall(r"\w+", (t or "").lower())
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if None not in (rows[i][0], rows[j][0]) and sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)].append(d)
    return Counter((d, min(least[find(i)]) if d is not None else None, links[i]) for i, (d, _) in enumerate(rows))


def test_near_duplicates(spark, awkward, nothing, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK", 16)
    r = np.random.default_rng(0)
    texts = []
    base = prose(50, 150).split()
    for i in range(120):  # one large group, so that buckets have several blocks
        own = list(base)
        for k in range(int(r.integers(0, 5))):
            own[int(r.integers(150))] = f"edit{i}x{k}"
        texts.append(" ".join(own))
    texts += [t.upper().replace(" ", " , ") for t in texts[:10]] + [prose(200 + i, 80) for i in range(30)]
    docs = frame(spark, texts, ids=list(range(100, 100 + len(texts)))).unionByName(awkward)
    got = near_duplicates.near_duplicates(docs)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert Counter(tuple(r) for r in got.collect()) == plain_links(rows)
    left = near_duplicates.drop_near_duplicates(docs)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == {c for _, c, _ in plain_links(rows)}
    assert near_duplicates.near_duplicates(nothing).count() == 0 and near_duplicates.drop_near_duplicates(nothing).count() == 0


def test_near_duplicates_of_ids_with_several_texts(spark):
    a, b, c = prose(1, 60), prose(2, 60), prose(3, 60)
    near = lambda t, w: t.replace(t.split()[-1], w)
    rows = [(3, a), (5, a + " x"), (5, b), (8, b), (8, b), (9, near(c, "y")), (2, c), (5, "..."), (None, a), (4, None), (4, b + " z"), (7, prose(4, 3)), (7, prose(4, 3))]
    docs = frame(spark, [t for _, t in rows], ids=[i for i, _ in rows]).repartition(3)
    assert Counter(tuple(r) for r in near_duplicates.near_duplicates(docs).collect()) == plain_links(rows)
    left = Counter((r["doc_id"], r["text"]) for r in near_duplicates.drop_near_duplicates(docs).collect())
    alone = [] if (9, 2, 1) in plain_links(rows) else [(9, near(c, "y"))]
    assert left == Counter([(3, a), (4, b + " z"), (2, c), (5, "..."), (None, a), (4, None), (7, prose(4, 3)), *alone])


def test_minhash_and_pruning():
    a, b = near_duplicates.shingles(prose(1, 300)), near_duplicates.shingles(prose(1, 300) + " " + prose(2, 40))
    same = len(set(a.tolist()) & set(b.tolist())) / len(set(a.tolist()) | set(b.tolist()))
    s = near_duplicates.signatures([a, b])
    assert abs((s[0] == s[1]).mean() - same) < 0.2
    for n, m in near_duplicates.least_matches().items():
        tail = lambda k: sum(math.comb(n + 1, i) * 0.8**i * 0.2 ** (n + 1 - i) for i in range(k + 1))  # noqa: B023, E731
        assert tail(m) >= near_duplicates.TOLERANCE > (tail(m - 1) if m else 0)


def test_components(spark, tmp_path):
    edges = [(i, i + 1) for i in range(30)] + [(100, 101), (102, 101), (200, 200)]
    got = near_duplicates.connected(spark.createDataFrame(edges, "a long, b long"), f"file://{tmp_path}/c")
    assert dict(map(tuple, got.collect())) == {i: 0 for i in range(1, 31)} | {101: 100, 102: 100}


# 8 PII


def test_pii(spark, awkward, nothing):
    texts = ["Call +1 (386) 555-3733 or +1 386-555-3733, bob@x.com BOB@X.COM c@d.org", "card 4041894974608795, 4041 8949 7460 8795, bad 4041894974608796", "25.86.162.211. v1.2.3.4.5 4.0. 300.1.1.1", "Frau Anna Schmidt, Herr Schmidt, Mr. Иван Петров; DE89 3704 0044 0532 0130 00; 123-45-6789"]
    out = {r["doc_id"]: r for r in pii.surrogates(frame(spark, texts), "k").collect()}
    a = re.fullmatch(r"Call \+1 \((\d{3})\) (\d{3})-(\d{4}) or \+1 (\d{3})-(\d{3})-(\d{4}), (\S+@\S+) (\S+@\S+) (\S+@\S+)", out[0]["text"]).groups()
    assert a[:3] == a[3:6] and a[:3] != ("386", "555", "3733") and a[7] == a[6].upper() and a[8] != a[6] and "x.com" not in out[0]["text"] and out[0]["n_pii"] == 5
    b = re.fullmatch(r"card (\d{16}), (\d{4} \d{4} \d{4} \d{4}), bad 4041894974608796", out[1]["text"]).groups()
    assert b[1].replace(" ", "") == b[0] != "4041894974608795" and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(b[0]))) % 10 == 0
    assert re.fullmatch(r"(\d{1,3}\.){3}\d{1,3}\. v1\.2\.3\.4\.5 4\.0\. 300\.1\.1\.1", out[2]["text"]) and "25.86" not in out[2]["text"]
    c = re.fullmatch(r"Frau (\S+) (\w+), Herr (\w+), Mr\. (\w+) (\w+); DE.{25}; 9\d\d-\d\d-\d{4}", out[3]["text"]).groups()
    assert c[1] == c[2] != "Schmidt" and c[0].split("-")[0] in pii.GIVEN["latin"]["f"] and c[3].split("-")[0] in pii.GIVEN["cyrillic"]["m"] and re.fullmatch("[А-я]+", c[4])
    again = {r["doc_id"]: r["text"] for r in pii.surrogates(frame(spark, texts), "k").collect()}
    assert again == {d: r["text"] for d, r in out.items()} and pii.surrogates(frame(spark, texts), "other").first()["text"] != out[0]["text"]
    same = pii.surrogates(awkward, "k")
    assert same.columns == [*awkward.columns, "n_pii"] and Counter((r["doc_id"], r["text"]) for r in same.collect()) == Counter((r["doc_id"], r["text"]) for r in awkward.collect())
    assert pii.surrogates(nothing, "k").count() == 0
    with pytest.raises(ValueError):
        pii.surrogates(nothing, "")


def test_mentions_of_an_entity_stay_one(spark):
    texts = [
        "Prof. Anna Schmidt came. Later Frau Anna Schmidt left; Schmidt came back, Anna's Schmidts did not. Schmidt",
        "Dr Kim Lee and Mr Kim Lee. kim",
        "Call +1 386-555-3733 or 386-555-3733 or (386) 555-3733, not +49 386 555 3733.",
        "Herr Alma Alma met Alma.",
        "Schmidt alone has no title here.",
    ]
    out = [r["text"] for r in pii.surrogates(frame(spark, texts), "k").orderBy("doc_id").collect()]
    a = re.fullmatch(r"Prof\. (\S+) (\w+) came\. Later Frau (\S+) (\w+) left; (\w+) came back, (\S+)'s Schmidts did not\. (\w+)", out[0]).groups()
    assert a[0] == a[2] == a[5] != "Anna" and a[1] == a[3] == a[4] == a[6] != "Schmidt" and a[0].split("-")[0] in pii.GIVEN["latin"]["f"]
    b = re.fullmatch(r"Dr (\S+) (\w+) and Mr (\S+) (\w+)\. kim", out[1]).groups()
    assert b[:2] == b[2:] and b[0].split("-")[0] in pii.GIVEN["latin"]["m"]
    c = re.fullmatch(r"Call \+1 (\d{3})-(\d{3})-(\d{4}) or (\d{3})-(\d{3})-(\d{4}) or \((\d{3})\) (\d{3})-(\d{4}), not \+49 (\d{3}) (\d{3}) (\d{4})\.", out[2]).groups()
    assert c[:3] == c[3:6] == c[6:9] != ("386", "555", "3733") and c[9:] not in (c[:3], ("386", "555", "3733"))
    d = re.fullmatch(r"Herr (\S+) (\w+) met (\w+)\.", out[3]).groups()
    assert d[1] == d[2] != "Alma" and out[4] == texts[4]


def test_surrogates_equal_a_plain_version(spark):
    """Each text against Python's own reading of the patterns: what is found is replaced alike everywhere, all else stays."""
    r = np.random.default_rng(6)
    people, mails = ["Anna Berg", "Otto Vale", "Lee"], [f"{w}@{v}.com" for w in WORDS[:4] for v in WORDS[4:6]]
    phones, cards = ["386-555-3733", "+1 386 555 3733", "(212) 555-0199"], ["4041894974608795", "4041 8949 7460 8795"]
    bits = [*mails, *phones, *cards, *[f"Mr {p}" for p in people], *[f"Dr. {p}" for p in people], "10.1.2.3", "123-45-6789", *WORDS[:10], "Berg", "Lee", "x@", "4041894974608796", "12-34"]
    texts = [" | ".join(r.choice(bits, size=r.integers(0, 12))) for _ in range(60)]
    found = re.compile("|".join(p.replace(r"\p{Lu}", "[A-Z]").replace(r"\p{Ll}", "[a-z]").replace(r"\p{L}", "[A-Za-z]") for p in pii.PATTERNS.values()))
    got = {x["doc_id"]: x for x in pii.surrogates(frame(spark, texts), "k").collect()}
    mapped: dict[str, set] = defaultdict(set)
    for i, text in enumerate(texts):
        before, after = text.split(" | "), got[i]["text"].split(" | ")
        titled = {w for m in found.finditer(text) if re.match("Mr|Dr", m[0]) for w in m[0].split(" ")[1:]}
        n = 0
        for x, y in zip(before, after, strict=True):
            whole = found.fullmatch(x)
            if re.match("Mr|Dr", x):
                title, *own = x.split(" ")
                assert y.startswith(title + " ") and len(y.split(" ")) == len(own) + 1
                for k, (w, v) in enumerate(zip(own, y.split(" ")[1:], strict=True)):
                    mapped["s" + w if k == len(own) - 1 else "g" + w].add(v)
                n += len(own)
            elif whole and x != "4041894974608796":
                digits = re.sub(r"\D", "", x)
                mapped["+" + digits[-10:] if x in phones else digits if x in cards else x].add(re.sub(r"\D", "", y)[-10:] if x in phones else re.sub(" ", "", y))
                n += 1
            elif x in titled:
                mapped["s" + x].add(y)
                n += 1
            else:
                assert x == y
        assert got[i]["n_pii"] == n
    assert all(len(v) == 1 for v in mapped.values()) and len({(k[0], *v) for k, v in mapped.items()}) == len(mapped)
    assert not any(next(iter(v)).lower() in {k.lower().lstrip("sg+") for k in mapped} for v in mapped.values())


def test_surrogates_stay_distinct(spark, tmp_path):
    """More one-letter emails than a first draw can tell apart; none becomes another's or an entity of the corpus."""
    entities = [("email", f"{c}@{d}.com", "n") for c in "abcdefghij" for d in "abcdefgh"] + [("given-latin", n, "f") for n in "anna berta carla dora emma frida gerda hanna ida jana".split()]
    got = pii.dictionary(spark.createDataFrame(entities, "kind string, entity string, gender string"), "k", f"file://{tmp_path}/d").collect()
    assert len(got) == len(entities) == len({(r["kind"], r["surrogate"]) for r in got}) and not {r["surrogate"] for r in got} & {e for _, e, _ in entities}


def test_pii_runs_no_python(spark):
    plan = pii.surrogates(frame(spark, ["a@b.com", "Mr Lee, Lee"]), "k")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# 9 LM scoring


def network(slots=1500, seed=0):
    """A network whose every parameter counts."""
    r = np.random.default_rng(seed)
    model = attention.Model(slots)
    model.p = {k: (w + 0.1 * r.standard_normal(w.shape)).astype(np.float64) for k, w in model.p.items()}
    return model


@pytest.mark.parametrize("deep", [True, False])
def test_attention_gradients(deep):
    r = np.random.default_rng(0)
    model, lengths = network(), np.array([70, 5, 0, 140, 33])
    stream, place, first = attention.spread(r.integers(0, 1500, lengths.sum()).astype(np.int32), lengths)
    given = attention.before(model.row(stream), first), first, place, stream[place]
    _, g, touched = model.gradients(*given, deep)
    assert len(touched) and g.keys() == (model.p.keys() if deep else {"class", "inner", "tails", "tail"})
    for name, d in g.items():
        if name == "tail":
            d = np.zeros_like(model.p[name])
            d[touched] = g[name]
        w, at = model.p[name], np.unravel_index(np.abs(d).argmax(), d.shape)
        old, loss = w[at], []
        for e in (1e-5, -1e-5):
            w[at] = old + e
            loss.append(model.gradients(*given)[0])
        w[at] = old
        assert abs((loss[0] - loss[1]) / 2e-5 - d[at]) < 1e-7


def plain_log_probability(model, y, k):
    """Of token k of one text, by loops: a query for EACH tokens, attention over the window, two levels."""
    p, e = model.p, []
    for t in range(k + 1):
        past = [y[t - 1 - j] if t - 1 - j >= 0 else 0 for j in range(attention.LAST)]
        e.append(sum(p["embed"][model.row(np.array(s)), j] for j, s in enumerate(past)))
    q_at = k - k % attention.EACH
    begin = max(0, k // attention.BLOCK - 1) * attention.BLOCK
    z = np.array(e) @ p["qkv"]
    keys, values = z[begin : q_at + 1, attention.KEY : 2 * attention.KEY], z[begin : q_at + 1, 2 * attention.KEY :]
    a = np.exp(keys @ z[q_at, : attention.KEY] + p["near"][q_at - np.arange(begin, q_at + 1)])
    h = e[k] + a @ values / a.sum()
    h = h + np.maximum(h @ p["w1"], 0) @ p["w2"]
    soft = lambda x: np.log(np.exp(x) / np.exp(x).sum())
    c, inner = divmod(y[k], attention.WIDE)
    if y[k] < attention.HEAD:
        return soft(h @ p["class"])[c] + soft(h @ p["inner"][c])[inner]
    kind, place = divmod(y[k] - attention.HEAD, model.wide)
    return soft(h @ p["class"])[attention.WIDE] + soft(h @ p["tails"])[kind] + soft(h @ p["tail"][kind])[place]


def test_attention_is_causal_and_scores_each_token_once():
    r = np.random.default_rng(0)
    model, lengths = network(), np.array([0, 1, 31, 32, 33, 64, 65, 200])
    y = r.integers(0, 1500, lengths.sum()).astype(np.int32)
    for at_once in (1, 2, 256):
        got = model.score(y, lengths, at_once)
        assert len(got) == len(y)
        ends = np.cumsum(lengths)
        for lo, hi in zip(ends - lengths, ends, strict=True):
            assert np.allclose(got[lo:hi], [plain_log_probability(model, y[lo:hi].tolist(), k) for k in range(hi - lo)], atol=1e-4)
    total = np.exp(model.log_probabilities(np.repeat(r.standard_normal((1, attention.D)), 1500, 0), np.arange(1500))).sum()
    assert total <= 1 + 1e-9 and total > 0.99  # the last class of the tail may have room


def test_products_of_many_rows_and_words_from_arrow():
    r = np.random.default_rng(0)
    for n in (0, 1, 128, 300):
        a, b, w = r.standard_normal((n, 32)), r.standard_normal((n, 33)), r.standard_normal((32, 33))
        assert np.allclose(attention.product(a, w), a @ w) and np.allclose(attention.gram(a, b), a.T @ b)
    own = language_model.subwords(language_model.VOCABULARY)
    ids, begin = own.of(language_model.pa.array(["the", "\u00dcn\u00ef"]))
    assert own.coder.decode(ids.tolist()) == " the \u00dcn\u00ef" and begin[0] == 0 and len(begin) == 2
    assert [len(x) for x in own.of(language_model.pa.array([], "string"))] == [0, 0]


def test_exponentials():
    r = np.random.default_rng(0)
    for shape, kind in (((exponentials.LEAST // 32 + 1, 32), np.float32), ((3, 5), np.float32), ((exponentials.LEAST, 2), np.float64)):
        z = (10 * r.standard_normal(shape)).astype(kind)
        want = np.exp(z.astype(np.float64))
        exponentials.exponentiate(z)
        assert z.dtype == kind and np.allclose(z, want, rtol=1e-5, atol=0)
    high = np.full(exponentials.LEAST, 100, np.float32)  # what the network's check for overflow looks for
    exponentials.exponentiate(high)
    assert np.isinf(high).all()
    half = np.zeros((exponentials.LEAST, 2), np.float32)
    exponentials.exponentiate(half[:, 0])
    assert (half == [1, 0]).all()


def test_attention_takes_no_exponentials_of_masked_places(monkeypatch):
    """Exponentials that are no normal numbers take several times as long; masked places are set to 0 behind them."""
    seen = []
    monkeypatch.setattr(attention, "exponentiate", lambda z: (seen.append(z.min()), np.exp(z, out=z)))
    model = attention.Model(1500)
    x = attention.before(np.arange(128, dtype=np.int32), np.array([True, False, True, False]))
    a = model.states(x, np.array([True, False, True, False]), True)[1][3]
    assert min(seen) > -87
    assert (a[[0, 2], :, : attention.BLOCK] == 0).all() and (a[:, 0, attention.BLOCK + 1 :] == 0).all() and np.allclose(a.sum(axis=2), 1)


def test_ids_of_the_head_are_those_of_texts():
    texts = language_model.pa.array(["a b  c \u00dcn\u00ef a", None, " ", "x" * 900 + " b", "c d"])
    place, lengths, words = language_model.split(texts)
    want = language_model.ids_of_texts(place, lengths, words, language_model.VOCABULARY)
    for head in ({}, {b"": 5, b"a": 3, b"x" * 900: 1, b"nowhere": 1}, {w.encode(): 1 for w in words.to_pylist()}):
        base = language_model.Base(head, 9, 5, 5)
        base.encode(language_model.VOCABULARY)
        at = np.asarray(language_model.pc.index_in(words.cast("binary"), value_set=base.words).fill_null(-1))
        assert language_model.ids_of_texts(place, lengths, words, language_model.VOCABULARY, base, at) == want


def test_attention_learns():
    texts = [np.append(2 + (np.arange(120) * 3 + i) % 40, 0) for i in range(40)]
    model = attention.Model(42)
    losses = model.fit(np.concatenate(texts).astype(np.int32), np.array([121] * 40), attention.Adam(model.p), 8e-3, steps=60)
    assert len(losses) == 60 and losses[-1] < 0.6 * losses[0]


def test_subwords_are_those_of_whole_texts():
    """Words one by one, as the vocabulary has them behind a space; long ones in pieces."""
    import tiktoken

    own = language_model.subwords(language_model.VOCABULARY)
    texts = ["a b  c\td\u00a0e", "", "  ", "\u0130x Ünï the thorti 日本 😀 '", "x" * 5000 + " y", prose(3, 200)]
    got = language_model.ids_of_texts(*language_model.split(language_model.pa.array(texts)), language_model.VOCABULARY)
    plain = tiktoken.Encoding("plain", pat_str=" [^ ]+", mergeable_ranks=own.coder._mergeable_ranks, special_tokens={})
    for t, ids in zip(texts, got, strict=True):
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) if w]
        ids = np.frombuffer(ids, "<u2").tolist()
        assert own.coder.decode(ids) == "".join(f" {w}" for w in words)
        if max(map(len, words), default=0) <= language_model.PIECE:
            assert ids == plain.encode_ordinary("".join(f" {w}" for w in words))


@pytest.mark.parametrize("head", [10, 10_000])
def test_lm_score(spark, awkward, head):
    docs = frame(spark, [prose(i, 30) + " Ünique\u00a0É" + str(i) for i in range(60)], ids=range(500, 560)).unionByName(awkward)
    got = language_model.score_documents(docs, head=head, sample=20, steps_=5).collect()
    tokens = [(r["doc_id"], [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or "")), ""]) for r in docs.collect()]
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0
    c = Counter(w for d, t in tokens if not held(d) for w in t)
    n, v = sum(c.values()), len(c)
    expected = sorted((str(d), held(d), len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), 4)) for d, t in tokens)
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == expected
    assert all(r["score"] < 0 for r in got)


def test_lm_score_of_nothing(spark, nothing):
    assert language_model.score_documents(nothing, steps_=5).count() == 0


def table_of_ids(spark, texts):
    ids = language_model.ids_of_texts(*language_model.split(language_model.pa.array(texts)), language_model.VOCABULARY)
    return ids, spark.createDataFrame([(i, bytes(b), -1 if i % 10 == 9 else i % language_model.ROUNDS) for i, b in enumerate(ids)], "doc_id long, ids binary, turn int")


def test_network_learns_from_all_training_documents(spark):
    """Texts over LONGEST, and ones beyond the sample, count as well: each token once."""
    texts = [" ".join(WORDS[(i + k) % len(WORDS)] for k in range(n)) for i, n in enumerate([6000] * 8 + [50] * 60)]
    ids, encoded = table_of_ids(spark, texts)
    scorer = language_model.learn(encoded, len(texts), sample=0, steps_=0)
    new = language_model.learn(encoded.filter("turn < 0"), 1, sample=0, steps_=0)
    new.slot, new.prior, new.model = scorer.slot, scorer.prior, attention.Model(len(scorer.prior))
    assert scorer.score([ids[3][:4000]])[0] > new.score([ids[3][:4000]])[0] + 20  # untrained before: equal
    assert language_model.train(encoded, scorer) == sum(len(b) // 2 + 1 for i, b in enumerate(ids) if i % 10 != 9)


def test_scores_of_a_model_are_the_means_of_its_slots(spark):
    """A text's score is the sum over its tokens of the mixture of network and counts; unseen ids share one slot."""
    ids, encoded = table_of_ids(spark, [prose(i, 40) for i in range(30)])
    scorer = language_model.learn(encoded, 27, sample=10, steps_=3)
    text = np.frombuffer(ids[0], "<u2").tolist() + [40000]  # no training text has this id
    y = [int(scorer.slot[i]) for i in text] + [language_model.END]
    assert y[-2] == language_model.OTHER
    each = [math.log10(0.95 * math.exp(plain_log_probability(scorer.model, y, k)) + 0.05 * scorer.prior[y[k]]) for k in range(len(y))]
    assert abs(scorer.score([np.array(text, "<u2").tobytes()])[0] - (sum(each) + scorer.other / math.log(10))) < 1e-2
    assert abs(math.exp(scorer.other) * (scorer.slot == language_model.OTHER).sum() - 1) < 1e-9


def test_each_id_has_its_own_slot_and_windows_overlap_by_half():
    counts = {i: 40_000 - i for i in range(0, 40_000, 7)}
    scorer = language_model.Scorer(counts, 5, language_model.VOCABULARY)
    slots = scorer.slot[list(counts)]
    assert len(set(slots.tolist())) == len(counts) and slots.min() == 2 and slots.max() < attention.HEAD + scorer.model.wide**2
    assert attention.WINDOW == 2 * attention.BLOCK and attention.LAST >= attention.EACH - 1


# 10 secrets

PLAIN = [re.compile(r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII), re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")]


def plain_secrets(text):
    found = sorted((m.start(), k, m.end()) for k, p in enumerate(PLAIN) for m in p.finditer(text) if len(m[1] if k == 0 else m[0]) >= (6, 20, 24)[k])
    joined = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in found)
    return [sum(x[1] == k for x in found) for k in range(3)], joined


def test_secrets(spark, awkward, nothing, monkeypatch):
    monkeypatch.setattr(automaton, "LANE", 32)
    r = np.random.default_rng(2)
    bits = ["token", "TOKEN", "secret", "password", "api_key", "apikey", '"', "'", " ", "=", ":", "abc", "AKIA", "ABCDEF123456789012345", "0123456789abcdef01234567", "é", "\n", "x", "AKIAQQ"]
    texts = ["".join(r.choice(bits, size=r.integers(0, 40))) for _ in range(800)] + ["deadbeef" * 2000, "token=" + "a" * 50_000, "AKIA" * 9, "ghp_" + "a" * 36, "-----BEGIN RSA PRIVATE KEY-----", "token=token\"=abcdefg"]
    docs = frame(spark, texts).unionByName(awkward.withColumn("doc_id", F.col("doc_id") + 5000))
    by_id = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] is not None}
    got = {r["doc_id"]: r for r in secret_scan.secret_scan(docs).collect() if r["doc_id"] is not None}
    assert got.keys() == by_id.keys()
    for d, t in by_id.items():
        counts, joined = plain_secrets(t or "")
        assert [got[d]["n_assign"], got[d]["n_access"], got[d]["n_hex"]] == counts, t
        assert got[d]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(got[d]["spans"].split(","))
    assert got[texts.index("ghp_" + "a" * 36)]["spans"] == "hex:4:40,github:0:40" or "github:0:40" in got[texts.index("ghp_" + "a" * 36)]["spans"]
    assert "pem:0:31" in got[texts.index("-----BEGIN RSA PRIVATE KEY-----")]["spans"]
    assert secret_scan.secret_scan(nothing).count() == 0


def test_automaton_is_minimal_and_right():
    a = automaton.compile_patterns([("a(b|c)*d", False), ("x{2,3}", True)], search=False)
    accepts = lambda t: a.longest(t)
    assert accepts(b"abcbd") == 5 and accepts(b"ad") == 2 and accepts(b"ab") == -1 and accepts(b"xXx") == 3 and accepts(b"x") == -1 and accepts(b"xxxx") == 3
    assert automaton.compile_patterns([("ab|cb", False)], search=False).states == 4  # start, before b, end, dead
    with pytest.raises(ValueError):
        automaton.compile_patterns([("a)", False)])
