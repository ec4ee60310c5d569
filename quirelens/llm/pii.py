"""Personal data: fixed forms, and the terms that give their bearers away.

Addresses, numbers and the like are found by their form. What stands beside one of them in the same texts and hardly
anywhere else gives it away even when it is masked: with counts over all texts, a term's pointwise mutual information
with the entity is compared with the entity's own information, and a term that reveals most of it is masked too,
wherever it stands in the texts that hold the entity. Every term of every text is scored with every entity of that text,
however far apart they stand and however few texts hold them; copies of a text count once. The term's count is smoothed
by one more text without the entity, which weighs most where it is low. Entities that stand in the same texts have the
same counts with every term and are scored as one. A term so frequent that it could not reveal the entity even if it
stood in all of the entity's texts is left out before pairs are made, which loses none.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelens.llm.common import Scratch, holds, key_bits, query, sized_batches, table, unused

KINDS = ("email", "ip", "card", "phone", "term")
BATCH_BYTES = 4 << 20
UNSEEN = 1  # texts assumed to hold the term without the entity, beyond those counted
KEY_RANGE = 1 << 40
MOST_TOTALS = 200_000  # terms counted in a task before their counts are passed on
DISCLOSURE = 0.8  # share of the entity's information that a term may not reach
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TERM = re.compile(r"[^\W\d_]{2,}")
MASKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]"}


def passes_luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses; going back from each domain keeps this linear in texts without spaces."""
    free = 0
    for m in DOMAIN.finditer(text):
        at = m.start()
        before = text[free:at]
        start = free + len(before.rstrip(LOCAL))
        free = at + 1
        if start < at:
            yield start, m.end()
            free = m.end()


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed forms in code points, by start, then kind; kinds may overlap each other."""
    found = [(s, e, "email") for s, e in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            found.append((*m.span(), "ip"))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and passes_luhn(digits):
                found.append((*m.span(), "card"))
    for m in PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            found.append((*m.span(), "phone"))
    return in_order(found)


def in_order(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def entity(value: str, kind: str) -> str:
    """One name for all spellings of a value."""
    return f"{kind}:{value.lower() if kind in ('email', 'ip') else re.sub('[^0-9]', '', value)}"


def terms_of(text: str, spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """(start, end, lower-cased term) of every term that starts outside the spans."""
    taken = [False] * (len(text) + 1)
    for s, e, _ in spans:
        taken[s:e] = [True] * (e - s)
    return [(m.start(), m.end(), m.group().lower()) for m in TERM.finditer(text) if not taken[m.start()]]


FOUND = "base string, entities array<string>, terms array<string>, held string"


def find_base(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text_key, base, entities, terms, held) of every row.

    ``held`` is the text where it has base spans, else null, and ``terms`` are its different terms outside them; ``row``
    numbers the rows once they are written.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = pa.list_(pa.string())
        for rows in sized_batches(batches, "text", BATCH_BYTES):
            bases, entities, terms, held = [], [], [], []
            for text in rows.column("text").to_pylist():
                spans = base_spans(text or "")
                bases.append(joined(spans))
                entities.append(list({entity(text[s:e], k) for s, e, k in spans}))
                terms.append(list({t for _, _, t in terms_of(text, spans)}) if spans else [])
                held.append(text if spans else None)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id").combine_chunks(), rows.column("text_key").combine_chunks(), pa.array(bases), pa.array(entities, many), pa.array(terms, many), pa.array(held, pa.string())],
                ["doc_id", "text_key", "base", "entities", "terms", "held"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(find, f"doc_id {kind}, text_key long, {FOUND}").withColumn("row", F.monotonically_increasing_id())


def term_places(found: DataFrame, flagged: DataFrame) -> DataFrame:
    """(row, terms) for each row with terms of the (text_key, term): start and end of all their occurrences outside base spans."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sized_batches(batches, "held", BATCH_BYTES):
            places = []
            for base, text, some in zip(*[rows.column(n).to_pylist() for n in ("base", "held", "some")]):
                wanted = set(some)
                places.append([at for s, e, term in terms_of(text, _spans(base, None)) if term in wanted for at in (s, e)])
            yield pa.RecordBatch.from_arrays([rows.column("row").combine_chunks(), pa.array(places, pa.list_(pa.int32()))], ["row", "terms"])

    own = flagged.groupBy("text_key").agg(F.collect_list("term").alias("some"))
    rows = found.filter("held IS NOT NULL").select("row", "text_key", "base", "held").join(own, "text_key")
    return rows.select("row", "base", "held", "some").mapInArrow(look, "row long, terms array<int>")


COUNTED = "text_key long, terms array<string>, counts array<long>"


def _counted(rows: list[tuple[int | None, list[str], list[int] | None]]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()))
    columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, ["text_key", "terms", "counts"])


def texts_with(docs: DataFrame, terms: DataFrame, copied: DataFrame, scratch: Scratch) -> DataFrame:
    """(term, n_term): in how many different texts each of the terms stands.

    Texts that stand once are counted inside their task, so a common word gives one row a task and not one a text. Of
    the texts that repeat (``copied`` holds their keys) one row of terms each is kept before they are counted alike.
    """
    context = docs.sparkSession.sparkContext
    bits = context.broadcast(key_bits(terms, F.crc32("term")))  # at most a megabyte
    repeated = context.broadcast(key_bits(copied, F.pmod("text_key", F.lit(KEY_RANGE))))  # at most a megabyte

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter[str] = Counter()
        for rows in sized_batches(batches, "text", BATCH_BYTES):
            keys = rows.column("text_key").to_pylist()
            many = holds(repeated.value, np.array(keys, dtype=np.int64) % KEY_RANGE)
            out = []
            for key, text, again in zip(keys, rows.column("text").to_pylist(), many.tolist()):
                words = list({w.lower() for w in TERM.findall(text or "")})
                if words:
                    hashed = np.fromiter((crc32(w.encode("utf-8", "surrogatepass")) for w in words), dtype=np.int64, count=len(words))
                    some = [words[i] for i in np.flatnonzero(holds(bits.value, hashed)).tolist()]
                    if again:
                        out.append((key, some, None))
                    else:
                        totals.update(some)
            if len(totals) > MOST_TOTALS:
                out.append((None, list(totals), list(totals.values())))
                totals.clear()
            yield _counted(out)
        yield _counted([(None, list(totals), list(totals.values()))])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter[str] = Counter()
        for rows in batches:
            for some in rows.column("terms").to_pylist():
                totals.update(some)
            if len(totals) > MOST_TOTALS:
                yield _counted([(None, list(totals), list(totals.values()))])
                totals.clear()
        yield _counted([(None, list(totals), list(totals.values()))])

    held = docs.select(F.xxhash64("text").alias("text_key"), "text").mapInArrow(count, COUNTED)
    held = scratch.write(held, "held")
    once = held.filter(F.col("text_key").isNotNull()).groupBy("text_key").agg(F.first("terms").alias("terms"))
    sums = held.filter(F.col("text_key").isNull()).unionByName(once.select("terms").mapInArrow(add, COUNTED))
    each = sums.select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).groupBy("x.terms").agg(F.sum("x.counts").alias("n_term"))
    return each.withColumnRenamed("terms", "term").join(terms, "term", "left_semi")


def reveals(texts: int, n_both: Column, n_entity: Column, n_term: Column) -> Column:
    """Whether a term tells at least DISCLOSURE of what an entity tells; of equal other counts a greater ``n_both`` tells more."""
    told = F.log(F.lit(float(texts)) * n_both / (n_entity * (n_term + UNSEEN)))
    return (told >= DISCLOSURE * F.log(F.lit(float(texts)) / n_entity)) & (told > 0)


def entity_classes(found: DataFrame, scratch: Scratch) -> DataFrame:
    """(text_key, class, n_entity) of every text with entities; entities of the same texts are one class.

    Texts are compared by two 64-bit hashes of their keys, added up bit by bit, and by their number.
    """
    stands = scratch.write(found.select(F.explode("entities").alias("entity"), "text_key").distinct(), "stands")
    same = F.struct(F.count("*").alias("n"), F.bit_xor(F.xxhash64("text_key")).alias("a"), F.bit_xor(F.xxhash64("text_key", F.lit(1))).alias("b"))
    each = stands.groupBy("entity").agg(same.alias("class"))
    return stands.join(each, "entity").select("text_key", "class", F.col("class.n").alias("n_entity")).distinct()


def revealing(docs: DataFrame, found: DataFrame, scratch: Scratch) -> DataFrame:
    """(text_key, term) where the term reveals an entity of the text, by counts over different texts."""
    classes = scratch.write(entity_classes(found, scratch), "classes")
    most = F.max("n_entity").alias("most")
    held = found.filter("held IS NOT NULL").groupBy("text_key").agg(F.first("terms").alias("terms"))
    held = scratch.write(held.join(classes.groupBy("text_key").agg(most), "text_key").select("text_key", "most", F.explode("terms").alias("term")), "texts")
    if held.isEmpty():
        return held.select("text_key", "term")
    copied = scratch.write(found.groupBy("text_key").agg(F.count("*").alias("n")).filter("n > 1").select("text_key"), "copied")
    known = scratch.write(held.select("term").distinct(), "known")
    texts = found.groupBy("text_key").agg(F.lit(1).alias("one")).count()
    # no term stands in more of an entity's texts than there are, so a pair that fails with all of them fails
    bound = lambda n_entity: reveals(texts, n_entity, n_entity, F.col("n_term"))
    greatest = F.lit(classes.agg(most).first().most)
    terms = scratch.write(texts_with(docs, known, copied, scratch).filter(bound(greatest)), "terms")
    rare = held.join(terms, "term").filter(bound(F.col("most"))).select("text_key", "term", "n_term")
    pairs = scratch.write(rare.join(classes, "text_key").filter(bound(F.col("n_entity"))), "pairs")
    both = pairs.groupBy("class", "term", "n_entity", "n_term").agg(F.count("*").alias("n_both"))
    flagged = both.filter(reveals(texts, F.col("n_both"), F.col("n_entity"), F.col("n_term"))).select("class", "term")
    return pairs.join(flagged, ["class", "term"], "left_semi").select("text_key", "term").distinct()


def find_all(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text_key, base, terms): each row's base spans and the places of its revealing terms.

    Null texts have none. Rows that repeat are listed each for itself; an empty table gives none. Only ``doc_id`` and
    ``text`` are read.
    """
    scratch = Scratch(docs.sparkSession, "pii")
    found = scratch.write(find_base(docs), "base")
    flagged = scratch.write(revealing(docs, found, scratch), "revealing")
    places = scratch.write(term_places(found, flagged), "places")
    return found.select("row", "doc_id", "text_key", "base").join(places, "row", "left")


def _spans(base: str, terms: list[int] | None) -> list[tuple[int, int, str]]:
    spans = []
    for part in base.split(",") if base else ():
        kind, start, end = part.split(":")
        spans.append((int(start), int(end), kind))
    pairs = list(zip(terms[::2], terms[1::2])) if terms else []
    return in_order(spans + [(s, e, "term") for s, e in pairs])


def report(docs: DataFrame) -> DataFrame:
    """Each row's counts by kind, the digest of its base spans, all spans, and the number of revealing terms."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            bases = rows.column("base").to_pylist()
            spans = [_spans(b, t) for b, t in zip(bases, rows.column("terms").to_pylist())]
            counts = [pa.array([sum(k == kind for _, _, k in s) for s in spans], pa.int64()) for kind in KINDS]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), *counts[:4], pa.array([hashlib.sha256(b.encode()).hexdigest() for b in bases]), pa.array([joined(s) for s in spans]), counts[4]],
                ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_terms"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return find_all(docs).select("doc_id", "base", "terms").mapInArrow(
        tell, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_terms long"
    )


def masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span replaced by its kind's mask; spans that overlap are replaced together, by the first's."""
    out, at = [], 0
    for s, e, kind in spans:
        if s >= at:
            out += [text[at:s], MASKS[kind]]
        at = max(at, e)
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame) -> DataFrame:
    """The documents with base spans and revealing terms masked in their texts; other columns and rows stay.

    A whole-number column ``n_chars`` gets the new length of a changed text. Null texts stay null, repeated rows are
    masked alike, an empty table stays empty. Other columns may have any names.

    Base spans are found again in the row. Only rows with revealing terms are looked up, by id and text hash.
    """
    names = docs.columns
    id_, key, own_terms = unused(docs, "_id", "_key", "_terms")
    terms = find_all(docs).filter(F.col("terms").isNotNull()).groupBy("doc_id", "text_key").agg(F.first("terms").alias(own_terms))
    terms = Scratch(docs.sparkSession, "pii").write(terms.select(F.col("doc_id").alias(id_), F.col("text_key").alias(key), own_terms), "terms")
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(key))
    rows = docs.join(terms, same, "left").select(*[docs[n] for n in names], own_terms)

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sized_batches(batches, "text", BATCH_BYTES):
            texts, changed = part.column("text").to_pylist(), []
            for i, (text, own) in enumerate(zip(texts, part.column(own_terms).to_pylist())):
                if text:
                    spans = base_spans(text)
                    if spans:
                        changed.append(i)
                        texts[i] = masked(text, in_order(spans + [(s, e, "term") for s, e in zip((own or [])[::2], (own or [])[1::2])]))
            columns = {n: part.column(n).combine_chunks() for n in names} | {"text": pa.array(texts, pa.string())}
            if "n_chars" in columns and pa.types.is_integer(columns["n_chars"].type):
                sizes = columns["n_chars"].to_pylist()
                for i in changed:
                    sizes[i] = len(texts[i])
                columns["n_chars"] = pa.array(sizes, columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names)

    return rows.mapInArrow(mask, docs.schema)


@query("op3_pii")
def pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The personal data in every document."""
    return report(table(spark, sf_dir, "documents"))
