"""Filters, classifier, tokens, packing and fingerprints against plain versions."""

import base64
import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark import cloudpickle

from attestor.llm import bpe, decontam, langid, packing, url_filter, winnow
from attestor.llm.common import NULL_ID
from attestor.llm.queries import URL_LABELS, URL_RULES

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def sha(x: bytes) -> str:
    return hashlib.sha256(x).hexdigest()


@pytest.fixture(scope="module")
def library():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


@pytest.fixture(scope="module")
def benchmark(spark, odd_docs):
    texts = [r.text for r in odd_docs.collect() if r.text]
    long = max(texts, key=len).split()
    return spark.createDataFrame(
        [(1, " ".join(long[40:62])), (2, "LAST,one"), (3, None), (4, "  "), (5, " ".join(long[45:70])),
         (6, "never seen words that no document has at all in it"), (7, "\u00e9t\u00e9 na\u00efve"), (None, "zzz")],
        "item_id long, text string")


def contaminated(documents, items):
    grams = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - 9, 1) if w else 0):
            grams.setdefault(tuple(w[i:i + 10]), set()).add(item)
    out = []
    for d, _, text in documents:
        w, hit, found = words(text), set(), set()
        for k in {len(g) for g in grams}:
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in grams:
                    hit.update(range(i, i + k))
                    found |= grams[tuple(w[i:i + k])]
        ids = sorted(str(x) for x in found if x is not None)
        out.append((None if d == NULL_ID else d, len(w), len(hit), len(ids), sha(",".join(ids).encode()), bool(hit)))
    return Counter(out)


@pytest.mark.parametrize("limit", [decontam.SET_LIMIT, 3])
def test_contamination(odd_docs, documents, benchmark, limit, monkeypatch):
    monkeypatch.setattr(decontam, "SET_LIMIT", limit)
    got = decontam.contamination(odd_docs, benchmark).drop("hit").collect()
    want = contaminated(documents, [(r.item_id, r.text) for r in benchmark.collect()])
    assert Counter(map(tuple, got)) == want and sum(k[5] for k in want) >= 3


def test_decontaminate_cuts_passages(spark, odd_docs, benchmark):
    out = decontam.decontaminate(odd_docs, benchmark)
    assert out.columns == odd_docs.columns
    assert decontam.contamination(out, benchmark).where("n_hit > 30").count() == 0
    clean = {r.text for r in decontam.contamination(odd_docs, benchmark).where("not contaminated")
             .join(odd_docs.select("doc_id", "text").distinct(), "doc_id").collect()}
    assert clean <= {r.text for r in out.collect()} | {None}
    docs = spark.createDataFrame([(1, "Keep! one two three four; end."), (2, "One two THREE four")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "one two three four")], "item_id long, text string")
    # more than half of document 1 is hit as well
    assert decontam.decontaminate(docs, items).collect() == []
    assert [r.text for r in decontam.decontaminate(docs, items, drop_share=0.9).collect()] == ["Keep! end."]


def test_no_benchmark(spark, odd_docs, no_docs, benchmark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contamination(odd_docs, none).where("contaminated").count() == 0
    assert decontam.decontaminate(odd_docs, none).count() == odd_docs.count()
    assert decontam.contamination(no_docs, benchmark).count() == 0


URLS = [None, "", "nourl", "http://", "://x.net/", "http://A.Example.NET/en/1?x#y", "https://example.net/enx",
        "http://example.net/en", "http://net/", "http://net", "http://a.b.example.com/de/", "http://example.com/DE/",
        "http://example.com/de", "ftp://x.org/fr/?q", "http://notexample.net/en/z", "http://org/fr/", "http://e.org#/fr/",
        "http://spam-farm.example.org/", "http://x/y://z.net/", "http://casino.net/", "http://x.casino.tv:80/", "http://\u00fcber.net/\u00e9"]


def judged(url):
    if not url or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in URL_RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    if fits:
        h, p, v = max(fits, key=lambda r: len(r[0] + r[1]))
        return host, path, h + p, v
    return host, path, None, "block" if set(host.split(".")) & set(URL_LABELS) else "allow"


@pytest.mark.parametrize("broadcast", [1 << 25, 0])
def test_url_filter(spark, broadcast, monkeypatch):
    monkeypatch.setattr(url_filter, "BROADCAST_BYTES", broadcast)
    rows = [(i, u, "z") for i, u in enumerate(URLS * 2)] + [(None, URLS[5], None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    rules = [url_filter.host_rule(*r) for r in URL_RULES] + [url_filter.label_rule(x, "block") for x in URL_LABELS]
    out = url_filter.url_filter(pages, url_filter.rules_frame(spark, rules))
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in out.collect()) == Counter(
        (i, *judged(u)) for i, u, _ in rows)
    assert url_filter.url_filter(pages.limit(0), url_filter.rules_frame(spark, rules)).count() == 0
    clash = pages.withColumnsRenamed({"verdict": "_best"}).withColumns({"_site": pages.url, "_row": pages.url, "token": pages.url})
    out = url_filter.url_filter(clash, url_filter.rules_frame(spark, rules))
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in out.collect()) == Counter(
        (i, *judged(u)) for i, u, _ in rows)


def test_bpe_equals_the_library(odd_docs, documents, library):
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256)
                  for r in bpe.token_digests(odd_docs, PATH, PATTERN).collect())
    want = Counter()
    for d, _, text in documents:
        ids = library.encode_ordinary(text)
        want[(None if d == NULL_ID else d, len(ids), sha(" ".join(map(str, ids)).encode()), sha(text.encode()))] += 1
    assert got == want


def test_bpe_round_trip(odd_docs, no_docs):
    ids = bpe.encode(odd_docs, PATH, PATTERN)
    back = Counter((r.doc_id, bytes(r.bytes)) for r in bpe.decode(ids, PATH, PATTERN).collect())
    assert back == Counter((r.doc_id, (r.text or "").encode()) for r in odd_docs.collect())
    assert bpe.encode(no_docs, PATH, PATTERN).count() == 0


def test_bpe_long_and_random_words(library):
    rng = np.random.default_rng(2)
    coder = bpe.Coder(bpe.load_ranks(PATH), PATTERN)
    texts = ["".join(rng.choice(list("theoransdi" + extra), n)) for extra in ("", "\u00e9\u00f1") for n in range(1, 260, 7)]
    texts += ["x" * 5000, "ab" * 999 + "a", " " * 700, "\u65e5" * 300]
    for t in texts:
        coder.learn(dict.fromkeys(coder.split(t)))
        ids, data = coder.coded(coder.split(t))
        assert [int(x) for x in ids.split()] == library.encode_ordinary(t) and data == t.encode()


def test_bpe_small_store(monkeypatch, odd_docs, library):
    monkeypatch.setattr(bpe, "STORE_WORDS", 5)
    coder = bpe.Coder(bpe.load_ranks(PATH), PATTERN)
    for t in ("one two three four five six", "seven one eight"):
        coder.learn(dict.fromkeys(coder.split(t)))
        assert [int(x) for x in coder.coded(coder.split(t))[0].split()] == library.encode_ordinary(t)


def test_bpe_words_met_lately_are_not_encoded_again(monkeypatch, library):
    monkeypatch.setattr(bpe, "STORE_WORDS", 4)
    asked = []
    query = bpe.Coder._query
    monkeypatch.setattr(bpe.Coder, "_query", lambda self, words: (asked.extend(words), query(self, words))[1])
    data = bpe.load_ranks(PATH)
    for t in ("aaqx bbqx ccqx ddqx", " eeqx aaqx", " ffqx bbqx aaqx"):
        coder = bpe._coder(data, PATTERN)  # each text in a task of its own
        coder.learn(dict.fromkeys(coder.split(t)))
        ids, back = coder.coded(coder.split(t))
        assert [int(x) for x in ids.split()] == library.encode_ordinary(t) and back == t.encode()
    assert len(asked) == len(set(asked))


def test_bpe_tasks_of_a_worker_share_a_coder():
    # a task gets the package's functions by value
    first, second = (cloudpickle.loads(cloudpickle.dumps(bpe._coder)) for _ in range(2))
    data = bpe.load_ranks(PATH)
    assert first(data, PATTERN) is second(data, PATTERN)
    cloudpickle.dumps(bpe._coder)


def test_bpe_bytes_come_from_the_ids():
    coder = bpe.Coder(bpe.load_ranks(PATH), PATTERN)
    other = coder.con.execute("SELECT hex FROM vocab WHERE id = ?", [coder.ranks[b"b"]]).fetchone()[0]
    coder.con.execute("UPDATE vocab SET hex = ? WHERE id = ?", [other, coder.ranks[b"a"]])
    words = coder.split("a c")
    coder.learn(dict.fromkeys(words))
    assert coder.coded(words)[1] == b"b c"


def test_language(spark, no_docs):
    rng = np.random.default_rng(3)
    vocab = {"en": "the and thing with which other ing tion", "de": "der und schen ung nicht mit lich keit",
             "fr": "le et eaux oui tion avec ment que", "es": "el y ción que los con mente ado", "xx": "zqj kkw vvu wqz"}
    rows = []
    for i in range(600):
        lang = list(vocab)[i % 5]
        rows.append((i, " ".join(rng.choice(vocab[lang].split(), 30)), lang if i % 7 else None))
    rows += [(9001, None, "en"), (9002, "123 !!", "de"), (9003, "", None), (None, "the and thing", "en"), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("lang_pred", langid.F.lit("x"))
    out = langid.identify(docs).collect()
    truth = {i: list(vocab)[i % 5] for i in range(600)}
    held = [r for r in out if r.held_out]
    assert len(out) == len(rows) and len(held) > 100
    assert np.mean([r.lang_pred == truth.get(r.doc_id, r.lang_pred) for r in held]) > 0.98
    assert {r.lang_pred for r in out if r.doc_id and r.doc_id > 9000} == {"und"}
    assert all(0 <= r.score <= 1 for r in out)
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 3
    assert langid.identify(no_docs).count() == 0
    blind = docs.withColumn("lang", langid.F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(blind).collect()} == {"und"}


def test_winnow(odd_docs, documents, no_docs):
    got = winnow.edited_report(odd_docs).collect()
    want, n = Counter(), len(documents)
    marks = [winnow.fingerprints([x[2]])[0] for x in documents]
    for i, (d, _, text) in enumerate(documents):
        nxt = documents[(i + 1) % n][2]
        cut = len(text) // 4
        edited = text[:len(text) - cut] + nxt[:cut]
        mark = winnow.fingerprints([edited])[0]
        want[(None if d == NULL_ID else d, len(text), sha(edited.encode()), winnow.written(marks[i]), winnow.written(mark),
              round(winnow.likeness(marks[i], mark), 9), round(winnow.likeness(marks[i], marks[(i + 1) % n]), 9))] += 1
    assert Counter((*tuple(r)[:5], round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == want
    assert winnow.edited_report(no_docs).count() == 0


def test_winnow_guarantee_and_rightmost_minimum():
    rng = np.random.default_rng(4)
    text = lambda n: "".join(rng.choice(list("abcdefgh \u00e9"), n))
    for _ in range(30):
        common = text(winnow.K + winnow.WINDOW - 1)
        a, b = winnow.fingerprints([text(50) + common + text(30), common + text(200)])
        assert set(a[:, 1].tolist()) & set(b[:, 1].tolist())
    # in a periodic text all windows have equal minima: the rightmost of each window is kept
    marks = winnow.fingerprints(["ab" * 100])[0][:, 0]
    assert list(np.diff(marks)) == [2] * (len(marks) - 1) or len(marks) <= 2 or (np.diff(marks) > 0).all()


def test_packing_round_trip(spark, odd_docs, no_docs, library):
    docs = odd_docs.where("doc_id is not null").dropDuplicates(["doc_id"]).coalesce(2)
    packed = packing.pack(docs, PATH, PATTERN, length=64, block_rows=16).cache()
    back = {}
    for r in sorted(packing.unpack(packed).collect(), key=lambda r: (r.doc_id, r.offset)):
        assert r.offset == len(back.get(r.doc_id, []))
        back.setdefault(r.doc_id, []).extend(r.ids)
    assert back == {r.doc_id: ids for r in docs.collect() if (ids := library.encode_ordinary(r.text or ""))}
    for r in packed.collect():
        ids, pos = np.frombuffer(r.ids, "<i4"), np.frombuffer(r.positions, "<i4")
        assert len(ids) == len(pos) == 64 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
        assert all(pos[a:b].tolist() == list(range(b - a)) for a, b in zip(r.cu_seqlens, r.cu_seqlens[1:]))
        assert (ids[r.n_tokens:] == packing.PAD).all()
    assert packing.pack(no_docs, PATH, PATTERN).count() == 0


def test_best_fit_is_the_tightest_open_row():
    rng = np.random.default_rng(6)
    for length in (1, 7, 64, 100):
        sizes = rng.integers(1, length + 1, 200).tolist()
        rows, room = [], []
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            fits = [r for r in range(len(rows)) if room[r] >= sizes[i]]
            if fits:
                best = min(room[r] for r in fits)
                r = max((r for r in fits if room[r] == best), key=lambda r: 0)
            else:
                rows.append([]), room.append(length)
                r = len(rows) - 1
            rows[r].append(i)
            room[r] -= sizes[i]
        got = packing.best_fit(sizes, length)
        assert sorted(i for r in got for i in r) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in r) <= length for r in got) and len(got) == len(rows)


def test_packing_very_long_runs():
    tokens = packing.Tokens(open(PATH, "rb").read(), PATTERN)
    assert len(tokens("\n" * 1_000_000)) > 1000
