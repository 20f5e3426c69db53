"""Personal data by patterns and by information-theoretic sanitisation.

The patterns find protected entities: addresses of mail and hosts, card and phone numbers. Then the
corpus tells which other terms give an entity away. A term is a word with a letter or digit, however
short, that touches no pattern's span. Addresses of one mail domain, and those that share a part of
the mailbox name, are also taken together, as an entity of their own, so that those seen once have
evidence. `P(entity | term)` is the share of the term's occurrences in
the corpus that lie within `REACH` words of that entity; its pointwise information about the entity
is `log2(P(entity | term) / P(entity))`. A term discloses if for some entity the share is at least
`SHARE`, the information is at least `BITS`, and it was seen in `SUPPORT` different contexts, or in
`LONE_SUPPORT` if it occurs nowhere else, so copies of one passage prove nothing. One context alone is
no evidence: any word that is seen once would disclose what it stands beside. Disclosing terms are spans of kind `term` wherever they occur, and `sanitise`
replaces every span by the name of its kind.

Pairs of entity and term are counted within `REACH` words, so a text gives pairs in proportion to
its length. All counts are aggregations that combine within tasks.

Nulls: a null text is empty and has no spans. Rows with equal id and text get equal results, each
one row; a null id stays null. An empty table gives an empty result. Columns other than `doc_id` and
`text` are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import SPACES, WORD, ship_package, stage, text_chunks, whole_text

# The kinds in their order.
KINDS = ("email", "ip", "card", "phone", "term")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# No digit in front and no way back into a run of digits: the same matches in linear time.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORDS = re.compile(WORD)
# Parts of a mailbox name that may name its owner.
NAMES = re.compile("[a-z]{3,}")

REACH = 8
SHARE = 0.5
BITS = 8.0
SUPPORT = 3
LONE_SUPPORT = 2
CHUNK_BYTES = 4 << 20
# Terms are sent to all tasks up to this many, and this many bytes of them.
SENT_TERMS = 200_000
SENT_BYTES = 8 << 20

Span = tuple[int, int, int]  # start, number of the kind, end

FOUND = (
    "doc_id long, row_key binary, n_words long,"
    " n_email long, n_ip long, n_card long, n_phone long,"
    " spans array<struct<start:int,kind:int,end:int>>,"
    " near array<struct<entity:string,term:string,context:long,n:int>>"
)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches by way of each `@`: only a whole run of local characters before it can match."""
    done, at = 0, text.find("@")
    while at >= 0:
        first = at
        while first > done and text[first - 1] in LOCAL:
            first -= 1
        domain = DOMAIN.match(text, at + 1) if first < at else None
        if domain:
            done = domain.end()
            yield first, done
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def pattern_spans(text: str) -> list[Span]:
    """The spans of the four patterns, by start and kind."""
    spans = [(a, 0, b) for a, b in _emails(text)]
    for m in IP.finditer(text):
        parts = [part.lstrip("0") for part in m.group().split(".")]
        if all(len(part) <= 3 and int(part or "0") <= 255 for part in parts):
            spans.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = _digits(m.group())
        if 14 <= len(digits) <= 19 and _luhn(digits):
            spans.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 10 <= len(_digits(m.group())) <= 15:
            spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def _is_term(word: str) -> bool:
    return any(c.isalnum() for c in word)


def _near(text: str, spans: list[Span]) -> list[tuple[str, str, int, int]]:
    """`entity, term, context, n`: terms within reach of each entity, by distinct places."""
    import bisect

    import xxhash

    if not spans:
        return []
    words = [(m.start(), m.end()) for m in WORDS.finditer(text)]
    starts, ends = [a for a, _ in words], [b for _, b in words]
    taken: set[int] = set()
    places: dict[str, list[tuple[int, int]]] = {}
    for start, kind, end in spans:
        low, high = bisect.bisect_right(ends, start), bisect.bisect_left(starts, end)
        taken.update(range(low, high))
        span = text[start:end]
        pools = [f"{KINDS[kind]}:{span}"]
        if kind == KINDS.index("email"):
            mailbox, _, domain = span.lower().rpartition("@")
            pools.append(f"domain:{domain}")
            pools += [f"name:{part}" for part in set(NAMES.findall(mailbox))]
        for entity in pools:
            places.setdefault(entity, []).append((max(0, low - REACH), min(len(words), high + REACH)))
    out: list[tuple[str, str, int, int]] = []
    for entity, ranges in places.items():
        counted: dict[tuple[str, int], int] = {}
        seen: set[int] = set()
        for low, high in ranges:
            window = text[starts[low] : ends[high - 1]]
            context = xxhash.xxh3_64_intdigest(window.encode("utf-8", "surrogatepass")) - (1 << 63)
            for k in range(low, high):
                word = text[starts[k] : ends[k]]
                if k not in taken and k not in seen and _is_term(word):
                    counted[word, context] = counted.get((word, context), 0) + 1
                seen.add(k)
        out += [(entity, word, context, n) for (word, context), n in counted.items()]
    return out


def _find_task():
    def find(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa

        span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
        near = pa.struct(
            [("entity", pa.string()), ("term", pa.string()), ("context", pa.int64()), ("n", pa.int32())]
        )
        for chunk in text_chunks(batches, CHUNK_BYTES):
            ids = chunk.column(chunk.schema.get_field_index("doc_id"))
            texts = chunk.column(chunk.schema.get_field_index("text")).to_pylist()
            keys, sizes, counts, spans, nears = [], [], [[], [], [], []], [], []
            for doc_id, text in zip(ids.to_pylist(), texts, strict=True):
                text = text or ""
                own = pattern_spans(text)
                # `bytes.split` parts at the same six characters as words do.
                sizes.append(len(text.encode("utf-8", "surrogatepass").split()))
                keys.append(hashlib.sha256(f"{doc_id}:{text}".encode("utf-8", "surrogatepass")).digest())
                for kind in range(4):
                    counts[kind].append(sum(1 for s in own if s[1] == kind))
                spans.append([{"start": a, "kind": k, "end": b} for a, k, b in own])
                nears.append(
                    [dict(zip(("entity", "term", "context", "n"), x, strict=True)) for x in _near(text, own)]
                )
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(keys, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    *(pa.array(c, pa.int64()) for c in counts),
                    pa.array(spans, pa.list_(span)),
                    pa.array(nears, pa.list_(near)),
                ],
                names=["doc_id", "row_key", "n_words", "n_email", "n_ip", "n_card", "n_phone", "spans", "near"],
            )

    return find


def _row_key() -> Column:
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("None")), F.lit(":"), whole_text())
    return F.unhex(F.sha2(named, 256))


def _few(terms: DataFrame) -> bool:
    """Whether stored `terms` are few and short enough to be sent to every task."""
    n, size = terms.agg(F.count(F.lit(1)), F.sum(F.octet_length("term"))).first()
    return n <= SENT_TERMS and (size or 0) <= SENT_BYTES


def _occurrences(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """`term, occurs`: how often each of the stored, distinct `terms` is a word of the texts.

    Few terms are sent to the tasks, so of all words only these are left to count. Many are met by
    the counts of all words, which tasks add up before anything is shuffled.
    """
    words = docs.select(F.explode(F.split(whole_text(), SPACES)).alias("term")).filter("term <> ''")
    if _few(terms):
        return words.join(F.broadcast(terms), "term", "left_semi").groupBy("term").agg(
            F.count(F.lit(1)).alias("occurs")
        )
    counted = words.groupBy("term").agg(F.count(F.lit(1)).alias("occurs"))
    return counted.join(terms, "term", "left_semi")


def disclosing_terms(
    docs: DataFrame,
    found: DataFrame,
    least_share: float = SHARE,
    least_bits: float = BITS,
    support: int = SUPPORT,
) -> DataFrame:
    """`term, lone` for each term that gives an entity away.

    All occurrences of a `lone` term are beside one entity.
    """
    near = found.select(F.explode("near").alias("p")).select("p.*")
    by_context = near.groupBy("entity", "term", "context").agg(F.sum("n").alias("n"))
    pairs = by_context.groupBy("entity", "term").agg(
        F.sum("n").alias("together"), F.count(F.lit(1)).alias("contexts")
    )
    lone_support = min(LONE_SUPPORT, support)
    pairs = stage(pairs.filter(F.col("contexts") >= lone_support), "pii-pairs")
    counted = _occurrences(docs, stage(pairs.select("term").distinct(), "pii-candidates"))
    of_entity = near.groupBy("entity").agg(F.sum("n").alias("beside"))
    total = found.agg(F.sum("n_words")).first()[0] or 0
    share = F.col("together") / F.col("occurs")
    bits = F.log2(share / (F.col("beside") / total))
    return (
        pairs.join(counted, "term")
        .join(of_entity, "entity")
        .filter((share >= least_share) & (bits >= least_bits))
        .withColumn("lone", F.col("together") == F.col("occurs"))
        .filter(F.col("lone") | (F.col("contexts") >= support))
        .groupBy("term")
        .agg(F.max("lone").alias("lone"))
    )


def _places_task():
    """Where the terms of a text lie, outside the patterns' spans."""

    def places(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for chunk in text_chunks(batches, CHUNK_BYTES):
            keys, starts, ends = [], [], []
            columns = [chunk.column(chunk.schema.get_field_index(c)).to_pylist() for c in ("row_key", "text", "terms")]
            for key, text, terms in zip(*columns, strict=True):
                wanted, own = set(terms), pattern_spans(text)
                for m in WORDS.finditer(text):
                    if m.group() in wanted and not any(a < m.end() and m.start() < b for a, _, b in own):
                        keys.append(key)
                        starts.append(m.start())
                        ends.append(m.end())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())],
                names=["row_key", "start", "end"],
            )

    return places


def personal_data(docs: DataFrame, **thresholds: float) -> DataFrame:
    """`doc_id, row_key, n_email, n_ip, n_card, n_phone, base, spans` for each row of `docs`.

    `base` has the patterns' spans and `spans` all of them, as (start, kind, end) in order; `kind`
    is a place in `KINDS`. `thresholds` are those of `disclosing_terms`.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = stage(rows.mapInArrow(_find_task(), FOUND), "pii-found")
    terms = stage(disclosing_terms(rows, found, **thresholds), "pii-terms")
    narrow = found.drop("near", "n_words").withColumnRenamed("spans", "base")
    if terms.isEmpty():
        return narrow.withColumn("spans", F.col("base"))
    # Lone terms are nowhere but beside entities, so only the others are looked for in all texts.
    hit = found.select("row_key", F.explode("near.term").alias("term")).join(terms.filter("lone"), "term")
    others = terms.filter("not lone")
    if not others.isEmpty():
        anywhere = rows.select(
            _row_key().alias("row_key"), F.explode(F.array_distinct(F.split(whole_text(), SPACES))).alias("term")
        )
        few = _few(others)
        hit = hit.unionByName(anywhere.join(F.broadcast(others) if few else others, "term"))
    hit = (
        hit
        .groupBy("row_key")
        .agg(F.collect_set("term").alias("terms"))
    )
    with_terms = rows.select(_row_key().alias("row_key"), whole_text().alias("text")).join(hit, "row_key")
    placed = with_terms.mapInArrow(_places_task(), "row_key binary, start int, end int").distinct()
    added = placed.groupBy("row_key").agg(
        F.collect_list(F.struct("start", F.lit(KINDS.index("term")).alias("kind"), "end")).alias("added")
    )
    return narrow.join(added, "row_key", "left").select(
        *narrow.columns,
        F.array_sort(F.concat("base", F.coalesce("added", F.array().cast("array<struct<start:int,kind:int,end:int>>")))).alias("spans"),
    )


def joined(spans: str) -> Column:
    """Spans as `kind:start:end`, comma-joined."""
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])
        ),
        ",",
    )


def sanitise(docs: DataFrame, **thresholds: float) -> DataFrame:
    """`docs` with every span of `text` replaced by the name of its kind in brackets.

    Of spans that overlap the first, then longest, is replaced. A null text stays null.
    """
    ship_package(docs.sparkSession)
    spans = personal_data(docs, **thresholds).filter(F.size("spans") > 0).select("row_key", "spans").distinct()

    @F.pandas_udf("string")
    def replaced(texts, all_spans):
        import pandas as pd

        out = []
        for text, own in zip(texts, all_spans, strict=True):
            if text is None or own is None:
                out.append(text)
                continue
            parts, done = [], 0
            for s in sorted(own, key=lambda s: (s["start"], -s["end"])):
                if s["start"] >= done:
                    parts += [text[done : s["start"]], f"[{KINDS[s['kind']]}]"]
                    done = s["end"]
            out.append("".join(parts) + text[done:])
        return pd.Series(out, dtype=object)

    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), _row_key().alias("row_key"))
    both = keyed.join(spans, "row_key", "left")
    new = replaced(F.col("row.text"), F.col("spans"))
    return both.select(*((new if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns))
