"""Each operator against brute force, on awkward rows, on nothing, and with clashing columns."""

from __future__ import annotations

import hashlib
import itertools
import json
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from leadtide.llm import chunks, fingerprints, langid, mixing, packing, pii, quality, simhash, suffixes, toxicity
from leadtide.llm.common import row_key, text_bytes
from leadtide.llm.components import components
from tests.llm.cases import ROWS, clashing, documents, rows, words


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


LABELS = "doc_id long, quality int, toxic int"


def labels(spark):
    return spark.createDataFrame(
        [(i, i % 2, i % 2) for i in range(12)] + [(None, 1, 1), (3, None, None), (4, 0, 1)], LABELS
    )


def operators(spark):
    """name -> function of documents."""
    model = quality.Model(np.zeros(3 * quality.SLOTS, np.float32), 1.0, 1.0, 0.0)
    bad = toxicity.Model({"karel": 6.0}, {}, 0.7, -6.0, (1.0, 1.0, -3.0))
    speech = langid.train([(words(300, i), lang) for i, lang in enumerate(["de", "en"])])
    return {
        "fingerprints": fingerprints.fingerprints,
        "packing": lambda d: packing.pack(d, tokenizer_path()),
        "simhash": simhash.near_duplicates,
        "pii": lambda d: pii.report(pii.find(d)),
        "sanitise": pii.sanitise,
        "quality": lambda d: quality.judge(d, model),
        "mixing": mixing.mix,
        "langid": lambda d: langid.identify(d, speech),
        "chunks": chunks.deduplicate_chunks,
        "toxicity": lambda d: toxicity.score(d, bad),
        "suffixes": suffixes.remove_repeats,
        "one_of_each": simhash.one_of_each_group,
    }


NAMES = ["fingerprints", "packing", "simhash", "pii", "sanitise", "quality", "mixing", "langid", "chunks", "toxicity",
         "suffixes", "one_of_each"]


@pytest.mark.parametrize("name", NAMES)
def test_awkward_empty_and_clashing(spark, name):
    run = operators(spark)[name]
    docs = documents(spark)
    plain = run(docs)
    result = rows(plain)
    assert run(docs.limit(0)).count() == 0
    other = run(clashing(docs))
    assert rows(other.select(*[f"`{c}`" for c in plain.columns])) == result
    if name not in ("packing", "mixing", "one_of_each"):
        assert len(result) == len(ROWS)
    if name in ("sanitise", "one_of_each"):
        clash = clashing(docs)
        assert other.columns == clash.columns


def test_fingerprints_by_brute_force(spark):
    found = {(r.doc_id, r.n_chars, r.fingerprint): r for r in fingerprints.fingerprints(documents(spark)).collect()}
    clean = [r for r in ROWS if r[0] is not None and r[0] != 4]
    by_id = sorted(clean, key=lambda r: -r[0])
    for r, after in zip(by_id, by_id[1:]):
        if r[0] - after[0] != 1 or after[0] == 4:
            continue
        text, following = r[1] or "", after[1] or ""
        third = len(text) // 3
        changed = text[: len(text) - third] + following[:third]
        row = found[(r[0], len(text), fingerprints.digest(text.encode()).hex())]
        assert row.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert row.edited_fingerprint == fingerprints.digest(changed.encode()).hex()
        assert 0 <= row.near_next <= 1
    assert fingerprints.likeness(b"a", b"a") == 1.0


def test_fingerprints_cross_partitions(spark):
    docs = spark.createDataFrame([(i, words(40, i)) for i in range(200)], "doc_id long, text string")
    found = {r.doc_id: r for r in fingerprints.fingerprints(docs).collect()}
    text = {i: words(40, i) for i in range(200)}
    for i in range(200):
        after = text[i - 1] if i else text[199]
        changed = fingerprints.edited(text[i], after).encode()
        assert found[i].edited_sha256 == hashlib.sha256(changed).hexdigest()


def test_fingerprint_counts():
    raw = words(50, 3).encode()
    counts = [0] * 256
    t = fingerprints._TABLES
    for p in range(len(raw) - 4):
        for k, (i, j) in enumerate(fingerprints._TRIPLETS):
            counts[t[0][raw[p]] ^ t[1 + k][raw[p + i]] ^ t[7 + k][raw[p + j]]] += 1
    q = [sorted(counts)[i] for i in (63, 127, 191)]
    codes = [sum(c > x for x in q) for c in counts]
    packed = bytes(codes[i] | codes[i + 1] << 2 | codes[i + 2] << 4 | codes[i + 3] << 6 for i in range(0, 256, 4))
    assert fingerprints.digest(raw)[1:] == packed


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    docs = documents(spark, [r for r in ROWS if r[0] is not None and r[0] != 4])
    pieces = packing.pack(docs, tokenizer_path()).collect()
    for doc_id, text, *_ in (r for r in ROWS if r[0] is not None and r[0] != 4):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        own = sorted((p for p in pieces if p.doc_id == doc_id), key=lambda p: p.start)
        assert [x for p in own for x in p.ids] == ids
        assert all(p.doc_tokens == len(ids) and p.length == len(p.ids) for p in own)
        assert all(p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes()) for p in own)
    of = {}
    for p in pieces:
        of.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in of.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024


def test_tokens_equal_tokenizers():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    ids = packing.TokenIds(tokenizer_path())
    texts = ["a b", " a", "a ", "a  b", "a \n b", "it's  we'll\n\n x", "é€😀 ñ  z  y", "\x1c a", "x\t y", "", " ", "a\n b\nc d"]
    texts += [words(50, 9).replace(" ", s) for s in (" ", "  ", "\n", " \n", "\n ", "\t ")]
    for text in texts * 2:
        assert np.frombuffer(ids.of(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("flags", [{}, {"lstrip": True, "single_word": True}])
def test_added_tokens_equal_tokenizers(tmp_path, flags):
    from tokenizers import Tokenizer

    with open(tokenizer_path(), encoding="utf-8") as file:
        held = json.load(file)
    end = held["added_tokens"][0]
    held["added_tokens"].append({**end, "id": end["id"] + 1, "content": end["content"] + "!", **flags})
    path = str(tmp_path / "tokenizer.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump(held, file)
    for name in (tokenizer_path(), path):
        tokenizer, ids = Tokenizer.from_file(name), packing.TokenIds(name)
        e = end["content"]
        for text in [f"x {e} y", e, f"{e}{e}", f"a  {e}\n b", f"a {e}! b", f"a{e}!b {e} ", f"<|{e}|>", e[:-1], f"é{e}\t z  y"]:
            want = tokenizer.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids.of(text), "<u4").tolist() == want, (name, text)


def test_differencing_keeps_all_and_levels():
    sizes = [int(x) for x in np.random.default_rng(1).integers(1, 257, 500)]
    windows = packing.near_equal_windows(sizes)
    assert sorted(i for w in windows for i in w) == list(range(500))
    sums = [sum(sizes[i] for i in w) for w in windows]
    assert max(sums) <= 1024 and max(sums) - min(sums) <= 64
    assert len(windows) <= -(-sum(sizes) // 1024) + 2
    assert packing.near_equal_windows([]) == [] and packing.near_equal_windows([5]) == [[0]]


def brute_fingerprint(text: str) -> int:
    w = text.encode().lower().split()
    if not w:
        return 0
    runs = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(r, seed=42) for r in runs]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def test_simhash_by_brute_force(spark):
    texts = [words(40, i) for i in range(40)] + [words(300, i) for i in range(40)]
    texts += [t + " nim" for t in texts[40:80]] + [t.upper() for t in texts[:5]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    bits = [brute_fingerprint(t) for t in texts]
    reach = list(range(len(bits)))
    for _ in bits:
        for i, j in itertools.combinations(range(len(bits)), 2):
            if (bits[i] ^ bits[j]).bit_count() <= 2:
                reach[i] = reach[j] = min(reach[i], reach[j])
    for i, b in enumerate(bits):
        assert found[i].fingerprint == f"{b:016x}"
        assert found[i].component_id == reach[i]
    assert len(set(reach)) < len(reach)


def test_links_lose_none(spark):
    r = np.random.default_rng(2)
    base = r.integers(0, 1 << 63, 300, dtype=np.int64)
    bits = sorted({int(b) ^ (1 << int(i)) ^ (1 << int(j)) for b in base for i, j in r.integers(0, 63, (4, 2))} | set(base.tolist()))
    df = spark.createDataFrame([(b,) for b in bits], "bits long")
    links = {frozenset((x.a, x.b)) for x in simhash.links(df, tile=16).collect()}
    group = {b: b for b in bits}

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in links:
        assert (a ^ b).bit_count() <= 2
        group[top(a)] = top(b)
    for a, b in itertools.combinations(bits, 2):
        if (a ^ b).bit_count() <= 2:
            assert top(a) == top(b)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 60)] + [(5000, 5000), (None, 1)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({found[i] for i in range(201)}) == 1
    assert len({found[1000 + i] for i in range(60)}) == 1
    assert len({found[0], found[1000], found[5000]}) == 3


def test_pii_patterns():
    text = "x a.b@c-d.org, 300.1.1.1 10.0.0.255, 4539 1488 0343 6467 call +49 (30) 123-4567 me@x @y.z a@b.c@d.e"
    kinds = [(pii.KINDS[k], text[s:e]) for s, k, e in pii.base_spans(text)]
    assert ("email", "a.b@c-d.org") in kinds and ("ip", "10.0.0.255") in kinds
    assert ("card", "4539 1488 0343 6467") in kinds and ("phone", "+49 (30) 123-4567") in kinds
    assert not any("300" in v for _, v in kinds)
    r = np.random.default_rng(4)
    for _ in range(300):  # the search from each @ equals the plain pattern
        text = "".join(r.choice(list("ab.@ -+1")) for _ in range(40))
        plain = [(m.start(), m.end()) for m in pii.EMAIL.finditer(text)]
        assert [(s, e) for s, k, e in pii.base_spans(text) if k == 0] == plain


def test_pii_report_by_brute_force(spark):
    import re

    def base(text):
        parts = {
            "email": [m for m in re.finditer(pii.EMAIL.pattern, text)],
            "ip": [m for m in re.finditer(pii.IP.pattern, text) if all(int(x) <= 255 for x in m[0].split("."))],
            "card": [], "phone": [],
        }
        for m in re.finditer(pii.CARD.pattern, text):
            digits = [int(c) for c in m[0] if c.isdigit()]
            doubled = [sum(divmod(2 * d, 10)) if k % 2 else d for k, d in enumerate(reversed(digits))]
            if 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
                parts["card"].append(m)
        for m in re.finditer(pii.PHONE.pattern, text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                parts["phone"].append(m)
        spans = sorted((m.start(), list(parts).index(k), m.end(), k) for k, found in parts.items() for m in found)
        return [len(found) for found in parts.values()], [f"{k}:{s}:{e}" for s, _, e, k in spans]

    r = np.random.default_rng(9)
    bits = ["4539 1488 0343 6467", "4539148803436468", "+49 (30) 123-4567", "+1 2", "10.0.0.255", "10.0.256.1", "1.2.3.4.5",
            "a.b@c-d.org", "é@x.y", "me@host.example.org", "€", "of all", "-", "378282246310005", "0"]
    texts = [" ".join(r.choice(bits, 12)) for _ in range(60)] + ["", None, "plain words"]
    every = [(k, t) for k, t in enumerate(texts)] * 3 + [(1, "other 10.0.0.1"), (None, None)]
    pii_rows = pii.report(pii.find(spark.createDataFrame(every, "doc_id long, text string"))).collect()
    want = []
    for doc_id, text in every:
        numbers, spans = base(text or "")
        want.append((doc_id, *numbers, hashlib.sha256(",".join(spans).encode()).hexdigest(), tuple(spans)))
    found = []
    for row in pii_rows:
        spans = tuple(s for s in row.spans.split(",") if s and not s.startswith("term:"))
        found.append((row.doc_id, row.n_email, row.n_ip, row.n_card, row.n_phone, row.base_sha256, spans))
    assert sorted(found, key=repr) == sorted(want, key=repr)  # a row for each row


def test_pii_report_in_shares(spark, monkeypatch):
    monkeypatch.setattr(pii, "SHARE", 3)
    docs = spark.createDataFrame([(1, "10.0.0.1")] * 7 + [(2, None)] * 3 + [(3, "x")], "doc_id long, text string")
    told = pii.report(pii.find(docs)).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in told} == {1: 7, 2: 3, 3: 1}


def test_disclosing_terms(spark):
    secret = "jo@home.example.org"
    texts = [f"{words(10, i)} captain zanzibar {secret} of {words(10, 50 + i)}" for i in range(4)]
    texts += [f"{words(20, 100 + i)} captain {words(5, 200 + i)} r{i}@other.example.org" for i in range(30)]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars int")
    found = {r.doc_id: r for r in pii.find(docs).collect()}
    for i in range(4):
        terms = [texts[i][t.start : t.end] for t in found[i].terms]
        assert "zanzibar" in terms and "captain" not in terms
    assert all(not found[i].terms for i in range(4, 34))
    masked = {r.doc_id: r for r in pii.sanitise(docs).collect()}
    assert "[EMAIL]" in masked[0].text and "zanzibar" not in masked[0].text and secret not in masked[0].text
    assert masked[0].n_chars == len(masked[0].text)


def test_disclosing_terms_of_a_single_document(spark):
    texts = [f"common words of {'all' if i % 2 else 'many'} documents" for i in range(400)]
    texts[7] += " then zanzibar jo@home.example.org of all"
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: [texts[r.doc_id][t.start : t.end] for t in r.terms] for r in pii.find(docs).collect()}
    assert set(found.pop(7)) == {"zanzibar", "then"}  # no other document has them
    assert not any(found.values())


def test_disclosing_terms_of_whole_documents(spark):
    texts = [f"common words of {'all' if i % 2 else 'many'} documents" for i in range(400)]
    texts[7] = f"Li 4471 {texts[7]} {'of all ' * 20} jo@home.example.org {'of all ' * 20} signed zanzibar, zanzibar LI"
    for i in (20, 21, 22):
        texts[i] = f"Ed Quux {'of all ' * 20} {texts[i]} eve@home.example.org or 10.1.2.3"
    texts[30] += " signed or"
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: [texts[r.doc_id][t.start : t.end] for t in r.terms] for r in pii.find(docs).collect()}
    assert found.pop(7) == ["Li", "4471", "zanzibar", "zanzibar", "LI"]  # another document has "signed"
    for i in (20, 21, 22):
        assert found.pop(i)[:2] == ["Ed", "Quux"]
    assert not any(found.values())


def test_quality_counts_by_brute_force():
    for text in [t or "" for _, t, *_ in ROWS if len(t or "") < 10_000] + ["a b c a b c d", "x\nx\n\n \nx y", "a#b $ <>", "a b c " * 30]:
        w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", text) if x]
        windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        covered = {p for i, x in enumerate(windows) if windows.count(x) > 1 for p in (i, i + 1, i + 2)}
        lines = [x for x in text.split("\n") if __import__("re").search(r"[^\x20\x09-\x0D]", x)]
        dup = sum(x in lines[:i] for i, x in enumerate(lines))
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered))
        assert quality.counts(text) == want


def test_quality_learns(spark):
    good = [(i, words(80, i), 1, 0) for i in range(80)]
    bad = [(100 + i, words(80, 500 + i).replace(" ", "$$ ##"), 0, 0) for i in range(80)]
    docs = spark.createDataFrame([r[:2] for r in good + bad], "doc_id long, text string")
    marked = spark.createDataFrame([(r[0], r[2], r[3]) for r in good + bad], LABELS)
    model = quality.fit(docs, marked, held_back=True)
    judged = quality.judge(docs, model).collect()
    right = [r for r in judged if (r.probability >= 0.5) == (r.doc_id < 100)]
    assert len(right) >= 0.97 * len(judged)
    scores = quality.margins(__import__("pyarrow").array([r[1] for r in good[:5]]), model.weights)
    dense = quality.features(__import__("pyarrow").array([r[1] for r in good[:5]])) @ model.weights
    assert np.allclose(scores, dense, atol=1e-3)


def test_quality_grams_by_brute_force():
    texts = ["aé€😀 aé€", "", None, "ñ", "x y x y", "€€€€", "z"]
    together = quality.features(pa.array(texts))
    for text, row in zip(texts, together):
        # the same alone as beside others
        assert np.array_equal(row, quality.features(pa.array([text], pa.string()))[0])
    chars, starts = quality._characters(*text_bytes(pa.array(texts)))
    for k, text in enumerate(texts):
        own = [int.from_bytes(c.encode(), "little") for c in text or ""]
        assert chars[starts[k] : starts[k + 1]].tolist() == own
    # characters of three bytes: equal grams but for the two at the end
    third = together[5][2 * quality.SLOTS :]
    assert sorted(third[third > 0].tolist()) == [0.25, 0.25, 0.5]


def test_models_take_nothing(spark):
    docs, none = documents(spark), labels(spark).limit(0)
    assert quality.quality_rules(docs, none).count() == len(ROWS)
    assert toxicity.toxicity(docs, none).count() == len(ROWS)
    assert {r.lang_pred for r in langid.languages(docs.limit(0)).collect()} == set()
    assert quality.quality_rules(docs, labels(spark)).count() == len(ROWS)
    assert toxicity.toxicity(docs, labels(spark)).count() == len(ROWS)
    assert langid.languages(docs).where("lang_pred = 'und'").count() == 5


def test_mixing_levels_sources(spark):
    docs = spark.createDataFrame([(i, words(5, i), "a" if i < 900 else None) for i in range(1200)], "doc_id long, text string, source string")
    mixed = mixing.mix(docs)
    n = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert abs(n["a"] - 600) < 90 and abs(n[None] - 600) < 120
    keys = [r.mix_key for r in mixed.collect()]
    assert keys == sorted(keys)
    weights = spark.createDataFrame([("a", 1.0), ("a", 0.5), ("z", 3.0)], "source string, weight double")
    only = {r.source for r in mixing.mix(docs, weights).select("source").distinct().collect()}
    assert only == {"a"}


def test_poisson_inverts(spark):
    from math import exp

    from pyspark.sql import functions as F

    df = spark.createDataFrame([(u / 97, rate) for u in range(97) for rate in (0.0, 0.3, 2.5, 40.0, 400.0)], "u double, rate double")
    for r in df.withColumn("k", mixing.poisson(F.col("u"), F.col("rate"))).collect():
        k, p = 0, exp(-r.rate)
        below = p
        while r.u >= below and k < 700:
            k += 1
            p = p * r.rate / k
            below += p
        assert r.k == k
    (large,) = spark.createDataFrame([(0.5, 2000.0)], "u double, rate double").select(mixing.poisson(F.col("u"), F.col("rate"))).first()
    assert abs(large - 2000) <= 1


def test_forward_backward_by_enumeration():
    r = np.random.default_rng(0)
    scores, starts, switch = r.normal(size=(9, 3)), np.array([0, 4, 4, 9]), r.random((3, 3)) + 0.1
    p, pairs = langid.forward_backward(scores, starts, switch, True)
    want, want_pairs = np.zeros((9, 3)), np.zeros((3, 3))
    for a, b in zip(starts, starts[1:]):
        total, own, both = 0.0, np.zeros((b - a, 3)), np.zeros((3, 3))
        for y in itertools.product(range(3), repeat=b - a) if b > a else ():
            w = np.exp(sum(scores[a + i, k] for i, k in enumerate(y))) * np.prod([switch[i, j] for i, j in zip(y, y[1:])])
            total += w
            for i, k in enumerate(y):
                own[i, k] += w
            for i, j in zip(y, y[1:]):
                both[i, j] += w
        if b > a:
            want[a:b] = own / total
            want_pairs += both / total
    assert np.allclose(p, want, atol=1e-5) and np.allclose(pairs, want_pairs, atol=1e-5)


def test_languages_of_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.97 * len(found)


def test_runs_of_spliced_texts(spark):
    """Stretches of held-out texts, put together, are found again."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs)
    told = docs.where("pmod(crc32(cast(cast(doc_id AS string) AS binary)), 4) = 2 AND length(text) > 200").orderBy("doc_id").limit(60)
    stretches = [(" ".join(r.text.split()[:25]), r.lang) for r in told.collect() if r.lang in model.languages]
    texts, want = [], []
    for i in range(0, len(stretches) - 2, 3):
        at, marks = 0, []
        for part, lang in stretches[i : i + 3]:
            marks += [(at, at + len(part), lang)]
            at += len(part) + 1
        texts.append(" ".join(part for part, _ in stretches[i : i + 3]))
        want.append(marks)
    assert len(texts) >= 10
    found = langid.word_runs(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    right = total = 0
    for r in found:
        for a, b, lang in want[r.doc_id]:
            total += b - a
            right += sum(max(0, min(b, x.end) - max(a, x.start)) for x in r.runs if x.lang == lang)
    assert right >= 0.9 * total


def test_runs_by_brute_force(spark):
    model = langid.train([(words(300, i), lang) for i, lang in enumerate(["de", "en"])])
    texts = [t for _, t, *_ in ROWS] + ["İstanbul " + words(9, 50) + " " + words(9, 1)]
    table = clashing(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    found = {r.doc_id: [tuple(x) for x in r.runs] for r in langid.word_runs(table, model).collect()}
    for i, text in enumerate(texts):
        want = []
        places = [m.span() for m in re.finditer(r"[A-Za-z\u0080-\U0010FFFF]+", text or "")]
        if places and any(c.isalpha() for c in text):
            raw = np.frombuffer("".join(c.lower() if len(c.lower()) == 1 else c for c in text).encode(), np.uint8)
            first, end, of_text = langid.words_of(raw, np.array([0, len(raw)]))
            p, _ = langid.forward_backward(langid.emissions(raw, first, end, model), of_text, model.transitions)
            labelled = zip(places, p.argmax(axis=1).tolist(), strict=True)
            for k, group in itertools.groupby(labelled, lambda x: x[1]):
                spans = [span for span, _ in group]
                want.append((spans[0][0], spans[-1][1], model.languages[k]))
        assert found[i] == want
    assert langid.word_runs(table.limit(0), model).count() == 0
    none = langid.word_runs(table, langid.train([])).collect()
    assert len(none) == len(texts) and not any(r.runs for r in none)


def test_toxicity_of_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    marked = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    found = toxicity.toxicity(docs, marked).join(marked, "doc_id").where("held_out").collect()
    hit = sum(r.toxic == 1 and r.predicted == 1 for r in found)
    assert hit >= 0.85 * sum(r.toxic == 1 for r in found)
    assert hit >= 0.85 * sum(r.predicted == 1 for r in found)


def test_segments_are_maximal():
    """Against the definition: split at the best segment, then go on with both sides."""
    r = np.random.default_rng(3)

    def brute(scores, low, high):
        best = max(((sum(scores[i:j]), -i, -j) for i in range(low, high) for j in range(i + 1, high + 1)), default=(0, 0, 0))
        if best[0] <= 1e-9:
            return []
        i, j = -best[1], -best[2]
        return brute(scores, low, i) + [(i, j - 1)] + brute(scores, j, high)

    for _ in range(200):
        n = int(r.integers(1, 14))
        scores = [float(r.integers(1, 40)) / 7 + r.random() / 100 if r.random() < 0.5 else -3 * r.random() for _ in range(n)]
        found = toxicity.segments(scores)
        assert [(a, b) for a, b, _ in found] == brute(scores, 0, n)
        assert all(abs(s - sum(scores[a : b + 1])) < 1e-9 for a, b, s in found)


def test_log_odds_of_both_signs():
    counts, toxic = Counter(bad=40, clean=400, even=500, rare=3), Counter(bad=38, clean=4, even=50, rare=1)
    scores = toxicity._log_odds(counts, toxic, 100, 1000, 1.0)
    assert scores["bad"] > 1 and scores["even"] == -1.0 and scores["clean"] < -1.5
    a, b = 4 * 40.5 / 1001 + 0.5, 4 * (1 - 40.5 / 1001) + 0.5
    odds = math.log((38 + a) / (62 + b)) - math.log((2 + a) / (898 + b))
    assert abs(scores["bad"] - (odds - math.sqrt(1 / (38 + a) + 1 / (2 + a)) - 1)) < 1e-12


def test_scores_by_brute_force(spark):
    """Scores and segments of every row from the definitions: all segments by splitting, E, the calibration."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").unionByName(documents(spark), True)
    model = toxicity.fit(docs, spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    assert min(model.words.values()) < -1.5 and max(model.words.values()) > 0

    def split(scores, low):
        total, start, best = 0.0, 0, (1e-9, 0, 0)
        for i, s in enumerate(scores):
            if total <= 0:
                total, start = 0.0, i
            total += s
            best = max(best, (total, -start, -i))
        if best[0] <= 1e-9:
            return []
        i, j = -best[1], -best[2] + 1
        return split(scores[:i], low) + [(low + i, low + j - 1, best[0])] + split(scores[j:], low + j)

    def brute(text):
        words = re.findall(r"[^\W\d_]+", (text or "").lower())
        scores = []
        for w in words:
            heads = [model.prefixes[w[:n]] for n in (6, 5, 4) if len(w) > n and w[:n] in model.prefixes]
            scores.append(model.words.get(w, heads[0] if heads else -toxicity.DRIFT))
        found = [(i, j, model.rate * s - model.size - math.log(max(len(words), 1))) for i, j, s in split(scores, 0)]
        found = [f for f in found if math.exp(-f[2]) <= 0.5 + 1e-12]
        a, b, bias = model.weights
        z = a * math.log1p(sum(f[2] for f in found)) + b * math.log1p(max((f[2] for f in found), default=0.0)) + bias
        return 1 / (1 + math.exp(-z)), found

    rows = docs.withColumn("doc_id", F.monotonically_increasing_id())
    texts = {r.doc_id: r.text for r in rows.collect()}
    scored = toxicity.score(rows, model).collect()
    assert len(scored) == len(texts)
    for r in scored:
        p, found = brute(texts[r.doc_id])
        assert abs(r.score - p) < 1e-6 and r.predicted == int(r.score >= 0.3)
        assert [(x.first, x.last) for x in r.segments] == [(i, j) for i, j, _ in found]


def test_gear_and_chunks():
    raw = np.frombuffer(words(400, 5).encode(), np.uint8)
    h, want = 0, []
    for b in raw.tolist():
        h = (2 * h + int(chunks._GEAR[b])) & 0xFFFFFFFF
        want.append(h)
    assert chunks.gear(raw).tolist() == want
    text = words(400, 5).encode()
    starts = np.array([0, len(text), len(text) + 40])
    both = np.frombuffer(text + b"y" * 40, np.uint8)
    found = list(chunks._chunks(both, starts))
    assert [e for t, _, e in found if t == 0][-1] == len(text)
    assert all(e - s >= chunks.LEAST for _, s, e in found)
    shifted = np.frombuffer(b"new start " + text, np.uint8)
    after = {bytes(shifted[s:e]) for _, s, e in chunks._chunks(shifted, np.array([0, len(shifted)]))}
    before = [bytes(both[s:e]) for t, s, e in found if t == 0]
    assert sum(c in after for c in before) >= len(before) - 3


def test_chunks_by_brute_force(spark):
    docs = documents(spark, [r for r in ROWS if r[0] is not None and r[0] != 4])
    found = {r.doc_id: r for r in chunks.deduplicate_chunks(docs).collect()}
    seen = set()
    for doc_id, text, *_ in sorted((r for r in ROWS if r[0] is not None and r[0] != 4), key=lambda r: r[0]):
        raw = (text or "").encode()
        kept = b""
        for _, s, e in chunks._chunks(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])):
            if raw[s:e] not in seen:
                kept += raw[s:e]
            seen.add(raw[s:e])
        assert found[doc_id].kept == kept
    assert found[2].n_removed > 100


def batch_of(texts):
    """Documents as operators read them; the doc_id is the place of the text's first row."""
    ids = [texts.index(t) for t in texts]
    keys = [hashlib.md5(f"{i}t{t}".encode()).digest() for i, t in zip(ids, texts)]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(keys, pa.binary()), pa.array(texts, pa.string())], ["doc_id", "key", "text"]
    )


def test_repeats_in_a_batch_travel_beside_the_buckets(monkeypatch):
    monkeypatch.setattr(chunks, "BATCH_BYTES", 6000)
    texts = [words(60, i) + " " + words(60, 70) for i in range(80)]
    batch = batch_of([*texts, texts[-1]])  # the last row comes twice
    out = pa.Table.from_batches(chunks._packed(iter([batch]), 40)).to_pylist()
    unpress = zstandard.ZstdDecompressor()
    known = [r["bucket"] for r in out if unpress.decompress(r["old"])]
    assert len(known) > 4 and len(set(known)) == len(known) and max(known) < 0
    assert all(not unpress.decompress(r["new"]) for r in out if r["bucket"] < 0)
    spans: dict[bytes, set] = {}
    for bucket in {r["bucket"] for r in out}:
        group = pa.Table.from_pylist([r for r in out if r["bucket"] == bucket])
        for row in chunks._repeated(group).to_pylist():
            spans.setdefault(row["key"], set()).update(zip(row["starts"], row["ends"]))
    seen = set()
    for key, text in zip(batch["key"].to_pylist(), texts):
        raw = text.encode()
        want = set()
        for _, s, e in chunks._chunks(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])):
            if raw[s:e] in seen:
                want.add((s, e))
            seen.add(raw[s:e])
        assert spans.get(key, set()) == want


def brute_suffixes(texts, length=100):
    seen, out = set(), []
    for raw in texts:
        covered = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            string = raw[s : s + length]
            if string in seen:
                covered[s : s + length] = b"\1" * length
            seen.add(string)
        out.append(bytes(x for x, c in zip(raw, covered) if not c))
    return out


@pytest.mark.parametrize("range_bytes", [12 << 20, 3000])
def test_suffixes_by_brute_force(spark, monkeypatch, range_bytes):
    monkeypatch.setattr(suffixes, "RANGE_BYTES", range_bytes)  # with 3000 some leading bytes fill several ranges
    shared = words(40, 70)
    texts = [words(30, i) + " " + shared * (i % 3) + " " + words(20, 900 + i) for i in range(60)]
    texts += ["z" * 700, "yz" * 300, "z" * 250, texts[5], texts[6][7:], "é" * 200 + shared]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(suffixes, "SAMPLE_OF", 1)
    found = {r.doc_id: r for r in suffixes.remove_repeats(docs).collect()}
    for i, kept in enumerate(brute_suffixes([t.encode() for t in texts])):
        assert found[i].kept == kept, i
        assert found[i].n_removed == len(texts[i].encode()) - len(kept)


def test_repeats_in_a_batch_travel_beside_the_ranges(monkeypatch):
    monkeypatch.setattr(suffixes, "MERGE_BYTES", 6000)
    texts = [words(60, i) + " " + words(30, 70) for i in range(80)]
    batch = batch_of([*texts, texts[-1]])  # the last row comes twice
    cuts = np.sort(suffixes._ordered(np.random.default_rng(1).integers(0, 1 << 63, 40, dtype=np.uint64)))
    out = pa.Table.from_batches(suffixes._blocks(iter([batch]), cuts, 100)).to_pylist()
    unpress = zstandard.ZstdDecompressor()
    known = [r["bucket"] for r in out if unpress.decompress(r["done"])]
    assert len(known) > 4 and len(set(known)) == len(known) and max(known) < 0
    assert all(not unpress.decompress(r["text"]) for r in out if r["bucket"] < 0)
    spans: dict[bytes, list] = {}
    for bucket in {r["bucket"] for r in out}:
        group = pa.Table.from_pylist([r for r in out if r["bucket"] == bucket])
        for row in suffixes._compare(group, 100).to_pylist():
            spans.setdefault(row["key"], []).extend(zip(row["starts"], row["ends"]))
    for key, text, kept in zip(batch["key"].to_pylist(), texts, brute_suffixes([t.encode() for t in texts])):
        gone = {x for s, e in spans.get(key, ()) for x in range(s, e)}
        assert bytes(x for i, x in enumerate(text.encode()) if i not in gone) == kept


def test_splitters_of_few_long_texts(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "RANGE_BYTES", 100_000)
    letters = np.random.default_rng(5).integers(97, 123, 2_000_000, dtype=np.uint8).tobytes().decode()
    docs = spark.createDataFrame([(i, letters[i * 500_000 :][:500_000]) for i in range(4)], "doc_id long, text string")
    docs = docs.select("doc_id", "text", row_key().alias("key"))
    assert not docs.where("pmod(xxhash64(key), 64) = 0").count()  # no whole document is of the sample
    cuts = suffixes.splitters(docs)
    assert len(cuts) == 19 and len(set(cuts.tolist())) == 19


def test_suffix_sort():
    r = np.random.default_rng(6)
    raw = r.integers(97, 99, 4000, dtype=np.uint8)
    at = r.integers(0, 3900, 500)
    order, common = suffixes.sort_suffixes(raw, at, np.full(500, 90), 1, 90)
    strings = [bytes(raw[a : a + 90]) for a in at]
    assert [strings[i] for i in order] == sorted(strings)
    for i in range(1, 500):
        a, b = strings[order[i - 1]], strings[order[i]]
        assert common[i] == next((k for k in range(90) if a[k] != b[k]), 90)
