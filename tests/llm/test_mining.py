"""Vector best fit, phrase mining and source divergence against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from leadtide.llm import divergence, phrases, vectorfit
from leadtide.llm.common import byte_runs, lower_ascii
from tests.llm.cases import ROWS, clashing, documents, rows, words


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


OPERATORS = {
    "vectorfit": lambda d: vectorfit.pack(d, tokenizer_path()),
    "phrases": lambda d: phrases.collocations(d, least=2),
    "divergence": lambda d: divergence.divergence(d, least_documents=2),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_and_clashing(spark, name):
    run = OPERATORS[name]
    docs = documents(spark)
    plain = run(docs)
    assert run(docs.limit(0)).count() == 0
    clash = run(clashing(docs))
    assert clash.columns == plain.columns
    # sequence numbers follow the partitions, which extra columns do not change
    assert rows(clash) == rows(plain)


def test_part_ids_equal_tokenizers():
    from tokenizers import Tokenizer

    odd = [
        "×a÷. ñó. (Ñ) ſŉ. …. é. ≮ é̱! ª. İ.", "x('s a.'t. (we'll) Á.b ≮ Z'S.", "İstanbul K K",
        "a<|endoftext|>b c", "é é  x　y İSTANBUL ΣΑΣ", "  ", "\x1cq\x1d r\x85s", "don't we'LL 'S 12³ ½ ﬁ", "", None,
        "a\n\n\tb\r\nc\x0bd\x0ce", "x ́y", "가 각ᆨ 한", "<|startoftext|> <|endoftext|><|endoftext|>", "<|ENDOFTEXT|>", "a1b2 c_d-e",
    ]
    random.seed(4)
    signs = "aAzéÉñ.,'( <≠́̇1٣ßſĲ…’\n\t sStTlL"
    odd += ["".join(random.choices(signs, k=12)) for _ in range(400)]
    plain = Tokenizer.from_file(tokenizer_path())
    encoder = vectorfit.PartIds(tokenizer_path())
    want = [plain.encode(t or "", add_special_tokens=False).ids + [vectorfit.END_ID] for t in odd]
    for group in ([*range(len(odd))], *([k] for k in range(len(odd)))):  # a batch with "<|", and each by itself
        ids, starts = encoder.of(pa.array([odd[k] for k in group], pa.string()))
        for place, k in enumerate(group):
            assert ids[starts[place] : starts[place + 1]].tolist() == want[k], repr(odd[k])


def greedy(demands: np.ndarray, capacities: np.ndarray, rule: str) -> list[list[int]]:
    """Vector best fit, one item at a time, with every bin looked at."""
    share = demands / capacities
    weight = share.mean(axis=0)
    order = sorted(range(len(demands)), key=lambda i: (-(share[i] @ weight), *demands[i][::-1], i))
    bins: list[list[int]] = []
    left: list[np.ndarray] = []
    for i in order:
        fits = [b for b in range(len(bins)) if np.all(left[b] >= demands[i])]
        if not fits:
            bins.append([i])
            left.append(capacities - demands[i])
            continue
        if rule == "norm":
            best = min(fits, key=lambda b: (((((left[b] - demands[i]) / capacities) ** 2) @ weight), b))
        else:
            best = max(fits, key=lambda b: ((left[b] / capacities * share[i]) @ weight, -b))
        bins[best].append(i)
        left[best] = left[best] - demands[i]
    return bins


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("capacities", [(100, 1000, 10_000), (100, 6, 10_000), (100, 8, 2_500)])
def test_best_fit_is_greedy_vector_best_fit(rule, capacities):
    rng = np.random.default_rng(3)
    lengths = np.concatenate([rng.integers(1, 50, 150), np.full(40, 7), np.ones(90, np.int64)])
    demands, held = vectorfit.demands_of(lengths), np.array(capacities)
    bins = vectorfit.best_fit(demands, held, rule)
    used = np.zeros((bins.max() + 1, 3), np.int64)
    np.add.at(used, bins, demands)
    assert np.all(used <= held) and np.all(used[:, 1] > 0)
    want = sorted(sorted(lengths[b].tolist()) for b in greedy(demands, held, rule))
    got = [sorted(lengths[bins == b].tolist()) for b in range(len(used))]
    if rule == "dot" or capacities[1] == 1000:
        assert len(got) == len(want)
    assert sorted(got) == want or abs(len(got) - len(want)) <= 1


def test_items_beyond_a_capacity_are_alone():
    bins = vectorfit.best_fit(vectorfit.demands_of(np.array([90, 5, 5, 90])), np.array([100, 10, 2000]))
    assert bins[0] != bins[3] and bins[1] == bins[2] and bins[1] not in (bins[0], bins[3])


@pytest.mark.parametrize("options", [{}, {"rule": "dot"}, {"capacity": 64, "most_documents": 3, "most_attention": 64 * 64}])
def test_vectorfit_round_trip(spark, options):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    more = [(100 + i, words(1 + i % 40, i), "en", "a") for i in range(300)] + [(500 + i, "", "en", "a") for i in range(40)]
    docs = documents(spark, ROWS + more).repartition(6)
    found = vectorfit.pack(docs, tokenizer_path(), **options).collect()
    capacity = options.get("capacity", vectorfit.CAPACITY)
    want = Counter()
    for doc_id, text, *_ in ROWS + more:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            cut = ids[start : start + capacity]
            want[doc_id, piece, start, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes()), tuple(cut)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in found) == want
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for placed in sequences.values():
        placed.sort()
        assert [o for o, _ in placed] == np.cumsum([0, *[n for _, n in placed][:-1]]).tolist()
        assert sum(n for _, n in placed) <= capacity and len(placed) <= options.get("most_documents", vectorfit.MOST_DOCUMENTS)
    if not options:  # six tasks together leave one sequence that is not full
        total = sum(r.length for r in found)
        assert len(sequences) <= total / capacity * 1.02 + 2


def pieces_of(text: str | None) -> list[list[str]]:
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def best_phrases(table: list[tuple], least: int, most_rank: int) -> list[tuple]:
    out = []
    for lang in {r[2] or "und" for r in table}:
        counts, n = Counter(), 0
        for _, text, own, _ in table:
            if (own or "und") == lang:
                for piece in pieces_of(text):
                    n += len(piece)
                    for size in (1, 2, 3):
                        counts.update(tuple(piece[i : i + size]) for i in range(len(piece) - size + 1))
        good = {p: a for p, a in counts.items() if a >= least and len(p) > 1}
        ranked = []
        for p, a in good.items():
            score, k = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            longer = [b for q, b in good.items() if len(q) > len(p) and p in (q[:2], q[1:])]
            if not any(100 * b >= 50 * a for b in longer):
                ranked.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:most_rank], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out, key=repr)


@pytest.mark.parametrize("sampling", [
    {}, {"sample_of": 1 << 40}, {"sample_of": 1, "least_in_sample": 1}, {"sample_of": 2, "least_in_sample": 3},
])
def test_collocations_by_brute_force(spark, sampling):
    text = words(40, 11)
    table = [r for r in ROWS if r[0] != 9] + [
        (20 + i, f"{text} End. Stop; {words(6, i % 3)}, É é Tab\tTab  a\x0bb c", lang, "s") for i, lang in
        enumerate(["en", None, "und", "en", "de", "en"])
    ]
    for least, most_rank in ((2, 2000), (3, 5)):
        found = phrases.collocations(documents(spark, table), least=least, most_rank=most_rank, **sampling)
        assert rows(found) == best_phrases(table, least, most_rank)


def test_border_failures_are_counted_in_further_passes(spark, monkeypatch):
    passes = []
    stored = phrases.stored
    monkeypatch.setattr(phrases, "stored", lambda df, name: (passes.append(name), stored(df, name))[1])
    phrases.frequent_phrases(documents(spark, [(1, "a b c " * 5, "en", "s")]), least=3, sample_of=1 << 40)
    assert passes == ["phrases"] * 3  # words; pairs of them; triples of those
    passes.clear()
    phrases.frequent_phrases(documents(spark, [(1, "a b c " * 5, "en", "s")]), least=3, sample_of=1)
    assert passes == ["phrases"]


def test_chance_hits_of_the_bitmaps_do_no_harm(spark, monkeypatch):
    monkeypatch.setattr(phrases, "_proposals", full := lambda hashes: phrases.Proposals(
        np.full(phrases.BITS // 8, 255, np.uint8), np.full(phrases.BITS // 8, 255, np.uint8)))
    assert full is phrases._proposals
    monkeypatch.setattr(phrases, "_missed", lambda *_: None)
    table = [(i, "x y z x y", "en", "s") for i in range(4)]
    assert rows(phrases.collocations(documents(spark, table), least=2)) == best_phrases(table, 2, 2000)


def sources_apart(table: list[tuple], least: int, most_rank: int) -> list[tuple]:
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in table:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        found = term.findall(low)
        counts[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
    out = []
    for lang in docs:
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        own = {s: c for (at, s), c in counts.items() if at == lang}

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares(c) for s, c in own.items()}
        q = shares(sum(own.values(), Counter()))
        for s in own:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in own if o != s]
            terms = [(q[t] - p[s][t], t.encode()) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:most_rank])):
                out += [(lang, s, part, item.decode(), -v, rank) for rank, (v, item) in enumerate(items, 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("group_rows", [1, 200_000])
def test_divergence_by_brute_force(spark, group_rows):
    table = ROWS + [(30 + i, words(60, i % 4) + " Ünlü ÜNLÜ " + "lang" * 9, "de", f"s{i % 3}") for i in range(6)]
    table += [(50, "only signs 1 2", "en", "empty"), (51, None, "xx", "p"), (52, "one", "xx", "q")]
    for least, most_rank in ((2, 50), (3, 2), (10**9, 50)):
        found = divergence.divergence(documents(spark, table), least, most_rank, group_rows)
        assert rows(found) == sources_apart(table, least, most_rank)


def test_term_counts_of_all_lengths():
    random.seed(5)
    texts = [" ".join(random.choice("ab é") * random.choice([1, 2, 7, 8, 9, 15, 16, 17, 33, 64, 300]) for _ in range(200))
             for _ in range(9)]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    starts = np.cumsum([0, *[len(t.encode()) for t in texts]])
    row, begin, end = byte_runs(lower_ascii(raw), starts, divergence._INSIDE)
    group = (row % 2) * 70_000
    at, n, docs = divergence.term_counts(raw, row, begin, end - begin, group)
    got = {(int(group[k]), bytes(raw[begin[k] : end[k]])): (int(a), int(b)) for k, a, b in zip(at, n, docs)}
    want, held = Counter(), defaultdict(set)
    for r, b, e, g in zip(row, begin, end, group):
        key = int(g), bytes(raw[b:e])
        want[key] += 1
        held[key].add(int(r))
    assert len(at) == len(got) and got == {k: (v, len(held[k])) for k, v in want.items()}


def test_radix_order_sorts():
    rng = np.random.default_rng(1)
    low, high = rng.integers(0, 1 << 63, 500).astype(np.uint64), rng.integers(0, 3, 500).astype(np.uint64)
    assert divergence.radix_order(low, high).tolist() == np.lexsort((low, high)).tolist()
