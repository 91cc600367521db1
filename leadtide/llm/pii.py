"""Personal data: fixed patterns, then terms that give the protected entities away.

The patterns find e-mail addresses, IP addresses, card and phone numbers.  Each value found
is a protected entity.  For each term of a document that holds entities, counts of documents
give its pointwise mutual information with an entity, PMI = log2(n * both / (term * entity)),
and the entity's own information, IC = -log2(entity / n).  PMI / IC is the share of the entity
that the term discloses; a term whose share reaches the threshold is a span wherever it stands
in the documents that hold the entity.
There is no least count: the entity's frequency among a term's documents is smoothed as if
``SMOOTHING`` more documents held the term, with the entity as often as in the whole corpus.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from leadtide.llm.common import pieces, restored, row_key, sheltered, stored

#: Kinds in the order of the report, and their patterns.
KINDS = ("email", "ip", "card", "phone")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: A term discloses an entity from this share of its information on.
THRESHOLD = 0.8
#: Documents added to those of a term, with entities as often as in all.
SMOOTHING = 2
BATCH_BYTES = 4 << 20
#: A row that is repeated is reported in shares of so many.
SHARE = 100_000
#: A worker hands on its term counts when it holds so many.
MOST_TERMS = 200_000

#: Terms are runs of letters and digits.
_WORD = re.compile(r"[^\W_]+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place in KINDS, end) of the fixed patterns, in order."""
    out = []
    at = text.find("@")
    done = 0
    while at >= 0:  # from each @ back over its local part; what comes before cannot match
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (found := EMAIL.match(text, start)):
            out.append((start, 0, found.end()))
            done = found.end()
        at = text.find("@", max(at + 1, done))
    for m in IP.finditer(text) if "." in text else ():
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text) if "+" in text else ():
        if 9 <= sum(map(str.isdigit, m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def terms_of(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[str, int, int]]:
    """(term, start, end) of each word; words that reach into the spans ``taken``, in order, are none."""
    k = 0
    for m in _WORD.finditer(text):
        while k < len(taken) and taken[k][1] <= m.start():
            k += 1
        if k == len(taken) or taken[k][0] >= m.end():
            yield m[0].lower(), m.start(), m.end()


def _taken(base: list) -> list[tuple[int, int]]:
    """Base spans in order, overlapping ones made one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted((x["start"], x["end"]) for x in base):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _scan(docs: DataFrame) -> DataFrame:
    """(key, doc_id, base, entities, held) of each row: the fixed spans, their values, and the text if there are any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, BATCH_BYTES):
            base, entities, held = [], [], []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text) if text else []
                base.append([{"start": s, "kind": k, "end": e} for s, k, e in spans])
                entities.append(sorted({f"{KINDS[k]}:{text[s:e]}" for s, k, e in spans}))
                held.append(text if spans else None)
            long, string = pa.int64(), pa.string()
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("doc_id"),
                 pa.array(base, pa.list_(pa.struct([("start", long), ("kind", long), ("end", long)]))),
                 pa.array(entities, pa.list_(string)), pa.array(held, string)],
                ["key", "doc_id", "base", "entities", "held"],
            )

    return docs.select(row_key().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run,
        "key binary, doc_id long, base array<struct<start: long, kind: long, end: long>>, "
        "entities array<string>, held string",
    )


def _terms(scanned: DataFrame) -> DataFrame:
    """(key, term): the words of each document that holds entities, once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, BATCH_BYTES, "held"):
            keys, terms = [], []
            for key, base, text in zip(*(batch.column(c).to_pylist() for c in ("key", "base", "held"))):
                own = {t for t, _, _ in terms_of(text, _taken(base))}
                keys += [key] * len(own)
                terms += own
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(terms, pa.string())], ["key", "term"])

    return scanned.where(F.size("entities") > 0).select("key", "base", "held").mapInArrow(run, "key binary, term string")


def term_counts(docs: DataFrame) -> DataFrame:
    """(term, documents): in how many documents each word stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def table() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["term", "n"]
            )
            seen.clear()
            return out

        for batch in pieces(batches, BATCH_BYTES):
            for text in batch.column("text").to_pylist():
                if text:
                    seen.update({w.lower() for w in set(_WORD.findall(text))})
                    if len(seen) > MOST_TERMS:
                        yield table()
        yield table()

    return docs.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("documents"))


def mutual(both: Column, documents: Column, holders: Column, total: Column) -> Column:
    """PMI of a term of ``documents`` and an entity of ``holders`` documents, smoothed."""
    usual = holders / total
    return F.log2((both + SMOOTHING * usual) / (documents + SMOOTHING) / usual)


def disclosing(scanned: DataFrame, docs: DataFrame, threshold: float) -> DataFrame:
    """(key, term) of the terms that disclose an entity of the document, at or over the threshold.

    Entities of the same documents have the same counts with every term, so they are one group
    (told apart by their number of documents and 128 bits of these).
    """
    each = scanned.select("key", F.explode("entities").alias("entity"))
    total = scanned.agg(F.count(F.lit(1)).alias("total"))
    entities = stored(
        each.groupBy("entity").agg(
            F.count(F.lit(1)).alias("holders"), F.bit_xor(F.xxhash64("key")).alias("high"),
            F.bit_xor(F.xxhash64("key", F.lit(1))).alias("low"),
        ).join(F.broadcast(total)).where(F.col("holders") < F.col("total")),  # one row
        "disclosing-entities",
    )
    group = ["holders", "high", "low"]
    groups = each.join(entities, "entity").select("key", "total", *group).distinct()
    information = -F.log2(F.col("holders") / F.col("total"))

    def reaches(both: Column) -> Column:
        return mutual(both, F.col("documents"), F.col("holders"), F.col("total")) >= threshold * information

    # No term of more documents can reach the threshold, even if it stood in each one of an entity.
    most = entities.agg(F.max("holders").alias("holders"), F.max("total").alias("total")).select(
        ((F.col("total") + SMOOTHING) * F.pow(F.col("holders") / F.col("total"), F.lit(threshold)) + 1).alias("most")
    )
    terms = stored(
        term_counts(docs).join(F.broadcast(most)).where(F.col("documents") <= F.col("most")).drop("most"), "disclosing-terms"
    )
    pairs = stored(
        _terms(scanned).join(terms, "term").join(groups, "key").where(reaches(F.least("documents", "holders"))),
        "disclosing-pairs",
    )
    shares = stored(
        pairs.where("holders > 1").groupBy("term", "documents", "total", *group).agg(F.count(F.lit(1)).alias("both"))
        .where(reaches(F.col("both"))).select("term", *group),
        "disclosing-shares",
    )
    # A term with an entity of one document stands there, so those pairs are decided.
    return pairs.where("holders = 1").select("key", "term").union(
        pairs.where("holders > 1").join(shares, ["term", *group]).select("key", "term")
    ).distinct()


def find(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(key, doc_id, times, base, terms) for each distinct row: fixed spans, and the spans of disclosing terms.

    One row for each key, with the number of rows that have it, so rows equal in doc_id and text
    count once.  A null or empty text has no spans.  Only doc_id and text are read.
    """
    rows = _scan(docs)
    same = [F.first(c).alias(c) for c in rows.columns if c != "key"]
    scanned = stored(rows.groupBy("key").agg(*same, F.count(F.lit(1)).alias("times")), "personal-data")
    terms = disclosing(scanned, docs, threshold).groupBy("key").agg(F.collect_list("term").alias("wanted"))  # of one text
    wide = scanned.drop("entities").join(terms, "key", "left")
    places = "array<struct<start: long, end: long>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, BATCH_BYTES, "held"):
            found = []
            for base, text, wanted in zip(*(batch.column(c).to_pylist() for c in ("base", "held", "wanted"))):
                known = frozenset(wanted or ())
                found.append([
                    {"start": s, "end": e} for t, s, e in terms_of(text, _taken(base)) if t in known
                ] if known else [])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("key", "doc_id", "times", "base")), pa.array(found, kind)],
                ["key", "doc_id", "times", "base", "terms"],
            )

    return wide.mapInArrow(
        run, f"key binary, doc_id long, times long, base array<struct<start: long, kind: long, end: long>>, terms {places}"
    )


def merged(base: list, terms: list) -> list[tuple[int, int, str]]:
    """All spans by start; base ones first where they begin together."""
    return [
        (s, e, kind) for s, _, kind, e in sorted(
            [(x["start"], x["kind"], KINDS[x["kind"]], x["end"]) for x in base]
            + [(x["start"], len(KINDS), "term", x["end"]) for x in terms]
        )
    ]


def report(found: DataFrame) -> DataFrame:
    """key, doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans of each row that ``find`` has read.

    A row that is repeated comes as often again: in shares of ``SHARE``, which are dealt out first.
    """
    kinds = F.array(*[F.lit(k) for k in (*KINDS, "term")])

    def of_kind(place: int) -> Column:  # a second parameter of the lambda would be the index in the array
        return F.size(F.filter("base", lambda span: span["kind"] == place))

    def named(span):
        return F.concat_ws(":", kinds[span["kind"].cast("int")], span["start"], span["end"])

    ordered = F.array_sort("base")
    every = F.array_sort(F.concat(
        F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))),
        F.transform("terms", lambda s: F.struct(
            s["start"].alias("start"), F.lit(len(KINDS)).cast("long").alias("kind"), s["end"].alias("end"))),
    ))
    told = found.select(
        "key", "doc_id", "times",
        *[of_kind(i).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(F.concat_ws(",", F.transform(ordered, named)), 256).alias("base_sha256"),
        F.concat_ws(",", F.transform(every, named)).alias("spans"),
    )
    shares = told.withColumn("share", F.explode(F.sequence(F.lit(0), ((F.col("times") - 1) / SHARE).cast("long"))))
    own = F.least(F.lit(SHARE), F.col("times") - F.col("share") * SHARE).cast("int")
    each = shares.repartition("key", "share").withColumn("copy", F.explode(F.array_repeat(F.lit(0).cast("byte"), own)))
    return each.drop("times", "share", "copy")


def mask(text: str | None, base: list, terms: list) -> str | None:
    """The text with base spans replaced by their kind and disclosing terms by [TERM]."""
    if not text:
        return text
    out, done = [], 0
    for start, end, kind in merged(base, terms):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def sanitise(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with masked texts, and n_chars (if there is such a column) after masking.

    One row out for each row in, repeated rows too; other columns stay as they are, whatever
    their names.  A null text stays null, with its n_chars.
    """
    found = find(docs, threshold).where((F.size("base") > 0) | (F.size("terms") > 0))
    wide = sheltered(docs, "doc_id", "text").withColumn("key", row_key()).join(
        found.select("key", "base", "terms"), "key", "left"
    ).select("doc_id", "text", "_rest", "base", "terms")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, BATCH_BYTES):
            rows = zip(*(batch.column(c).to_pylist() for c in ("text", "base", "terms")))
            texts = pa.array([mask(t, b, n) if b or n else t for t, b, n in rows], pa.string())
            yield batch.set_column(1, "text", texts).drop_columns(["base", "terms"])

    masked = wide.mapInArrow(run, StructType(wide.schema.fields[:3]))
    out = masked.select(*restored(masked, docs, "doc_id", "text"))
    if "n_chars" not in docs.columns:
        return out
    kind = docs.schema["n_chars"].dataType
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
