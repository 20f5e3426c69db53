"""Repair of the turn structure of conversations by cheapest edits.

A repaired conversation's role initials read `(s?(ua)+)?`: perhaps a system row, then user and
assistant in turn. Rows are kept, given the role that is due, deleted, or empty ones are inserted;
rows that are blank or repeat an earlier row go, and what ends in mid-sentence costs extra. The
edits with the least cost are taken and of these the ones whose audit, their initials D, I, K, R in
order, is least in ASCII (`repair_paths`).

Rows are narrowed to a digest and numbered over the whole table in the order of conversation, turn,
role and digest. A row is a duplicate if it is not the first with its conversation, role and digest;
the firsts are an aggregate, joined back by row number, so no key is hot. Then a conversation is a
byte per row, put together from pieces of `PIECE` rows. It is never longer than the audit that its
result row has to hold, and beside the two a task holds one segment of the graph. Texts are read
again for the repaired rows: sorted by conversation, they stream past their audit one at a time, as
SHA-256 over a conversation has to take them.

Order: turns ascending, null first; rows of one turn by role, then MD5 of the text; rows alike in
all of that are interchangeable. Nulls: a null role or text is one space; a null conversation id is
a conversation of its own. Conversations without rows that are asked for by id have zeros, an empty
audit and the digest of the empty string. A span of turns too large for a long is the largest long.
An empty table gives an empty result. Columns other than conv_id, turn, role, text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.common import ship_package
from tideline.llm.numbering import numbered

# One row in so many meets each kind of damage; what counts as space and as an end.
DAMAGES = 20
SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
PIECE = 4096
LARGEST = (1 << 63) - 1

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) after a damage that their conversation and turn decide.

    Of crc32(`conv_id:turn`) modulo 20, 0 drops a row, 1 empties its text, 2 takes `.!?` out of it,
    3 repeats the row and 4 makes its role user. Nulls read as one space, but ids and turns stay null.
    """

    def spelled(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(spelled("conv_id"), F.lit(":"), spelled("turn"))) % DAMAGES
    role, text = spelled("role"), spelled("text")
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(1), times)).alias("copy"),
    ).drop("copy")


def _plain(rows: DataFrame) -> DataFrame:
    """The four columns without nulls in role and text, and the digest that orders them."""
    text = F.coalesce(F.col("text"), F.lit(" "))
    return rows.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role"), F.lit(" ")).alias("role"),
        F.md5(text).alias("digest"),
        text.alias("text"),
    )


def _coded(rows: DataFrame) -> DataFrame:
    """Numbered rows, each with the letter for its fault and initial: "A" + 4 * fault + initial."""
    from tideline.llm.repair_paths import FAULTS, INITIALS

    trimmed = F.rtrim(F.col("text"), F.lit(SPACE))
    narrow = _plain(rows).select(
        "conv_id",
        "turn",
        "role",
        "digest",
        (trimmed == "").alias("blank"),
        (~F.substring(trimmed, -1, 1).isin(*ENDS)).alias("truncated"),
    )
    ranked = numbered(narrow, ["conv_id", "turn", "role", "digest"], "repair-rows")
    firsts = (
        ranked.groupBy("conv_id", "role", "digest")
        .agg(F.min("number").alias("number"))
        .select("number", F.lit(True).alias("is_first"))
    )
    fault = (
        F.when(F.col("blank"), FAULTS.index("blank"))
        .when(F.col("is_first").isNull(), FAULTS.index("duplicate"))
        .when(F.col("truncated"), FAULTS.index("truncated"))
        .otherwise(0)
    )
    initial = F.lit(INITIALS.index(""))
    for k, name in enumerate(INITIALS[:-1]):
        initial = F.when(F.substring("role", 1, 1) == name, k).otherwise(initial)
    code = F.char(F.lit(ord("A")) + fault * len(INITIALS) + initial)
    return ranked.join(firsts, "number", "left").select("conv_id", "turn", "number", code.alias("code"))


def _audit_task(batches: Iterator) -> Iterator:
    import pyarrow as pa

    from tideline.llm import repair_paths as paths

    lower = bytes.maketrans(bytes(65 + c for c in paths.CODES), bytes(paths.CODES))
    kinds = len(paths.INITIALS)

    def counted(codes: bytes, pieces: list[dict]) -> list[int]:
        gaps, last = 0, None
        turns = [p for p in pieces if p["least"] is not None]
        if turns:
            distinct = 0
            for piece in turns:
                # A turn may go on in the next piece.
                distinct += piece["turns"] - (piece["least"] == last)
                last = piece["most"]
            gaps = min(LARGEST, last - turns[0]["least"] + 1 - distinct)
        of_fault = [0] * len(paths.FAULTS)
        pairs = 0
        for code in paths.CODES:
            of_fault[code // kinds] += codes.count(code)
        initials = codes.translate(bytes(c % kinds for c in range(256)))
        for pair in paths.LEGAL_PAIRS:
            # The two initials of a legal pair differ, so its places do not overlap.
            pairs += initials.count(bytes(map(paths.INITIALS.index, pair)))
        return [gaps, *of_fault[1:], max(0, len(codes) - 1) - pairs]

    for batch in batches:
        every = batch.column(1).to_pylist()
        conversations = [
            "".join(p["codes"] for p in pieces).encode().translate(lower) for pieces in every
        ]
        columns = [[] for _ in range(len(COUNTS) + 1)]
        found = paths.cheapest_edits(conversations)
        for codes, pieces, (cost, audit) in zip(conversations, every, found, strict=True):
            for column, value in zip(columns, [*counted(codes, pieces), cost, audit], strict=True):
                column.append(value)
        arrays = [pa.array(c, pa.int64()) for c in columns[:-1]] + [pa.array(columns[-1], pa.string())]
        yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["conv_id", *COUNTS, "audit"])


def audits(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation: `conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`.

    `ids` (conv_id) names conversations that have a row here even without rows of their own.
    """
    ship_package(rows.sparkSession)
    by_number = F.array_sort(F.collect_list(F.struct("number", "code")))
    pieces = (
        _coded(rows)
        .groupBy("conv_id", F.floor(F.col("number") / PIECE).alias("piece"))
        .agg(
            F.array_join(F.transform(by_number, lambda x: x["code"]), "").alias("codes"),
            F.size(F.collect_set("turn")).alias("turns"),
            F.min("turn").alias("least"),
            F.max("turn").alias("most"),
        )
        .select("conv_id", F.struct("piece", "codes", "turns", "least", "most").alias("piece"))
    )
    if ids is not None:
        nothing = F.lit(None).cast(pieces.schema["piece"].dataType)
        pieces = pieces.unionByName(ids.select("conv_id").distinct().withColumn("piece", nothing))
    # A byte per row, like the audit that the same row is to hold.
    whole = pieces.groupBy("conv_id").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    longs = [T.StructField(name, T.LongType()) for name in COUNTS]
    schema = T.StructType([rows.schema["conv_id"], *longs, T.StructField("audit", T.StringType())])
    return whole.mapInArrow(_audit_task, schema)


def _beside_audits(rows: DataFrame, audit_rows: DataFrame) -> DataFrame:
    """Each conversation's audit, then its rows in order, in one partition."""
    texts = _plain(rows)
    columns = {**{name: "long" for name in COUNTS}, "audit": "string"}
    order = ["turn", "role", "digest"]
    heads = audit_rows.select(
        "conv_id",
        F.lit(0).alias("part"),
        *(F.lit(None).cast(texts.schema[c].dataType).alias(c) for c in [*order, "text"]),
        *columns,
    )
    bodies = texts.select(
        "conv_id",
        F.lit(1).alias("part"),
        *order,
        "text",
        *(F.lit(None).cast(kind).alias(c) for c, kind in columns.items()),
    )
    return (
        heads.unionByName(bodies)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "part", *order)
        .drop("turn", "digest")
    )


def _conversations(batches: Iterator) -> Iterator:
    """For every conversation its head, a dict, and its repaired rows as an iterator."""
    from itertools import groupby

    from tideline.llm.repair_paths import edited

    rows = (row for batch in batches for row in batch.to_pylist())
    heads = 0

    def number(row: dict) -> int:
        # Conversations begin with their head; null ids are told from others that way as well.
        nonlocal heads
        heads += row["part"] == 0
        return heads

    for _, own in groupby(rows, number):
        head = next(own)
        yield head, edited(head["audit"], ((row["role"], row["text"]) for row in own))


CHUNK_ROWS = 2000


def _in_batches(rows: Iterator[dict], names: list[str], kinds: list) -> Iterator:
    from itertools import islice

    import pyarrow as pa

    while some := list(islice(rows, CHUNK_ROWS)):
        arrays = [pa.array([row[n] for row in some], kind) for n, kind in zip(names, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def _arrow_kinds(schema: T.StructType) -> list:
    from pyspark.sql.pandas.types import to_arrow_type

    return [to_arrow_type(field.dataType) for field in schema]


def repaired(rows: DataFrame, audit_rows: DataFrame) -> DataFrame:
    """The repaired conversations: `conv_id, position, role, text`, positions from 0.

    `audit_rows` are what `audits` found for `rows`.
    """
    ship_package(rows.sparkSession)
    schema = T.StructType(
        [
            rows.schema["conv_id"],
            T.StructField("position", T.LongType()),
            T.StructField("role", T.StringType()),
            T.StructField("text", T.StringType()),
        ]
    )
    kinds, names = _arrow_kinds(schema), schema.names

    def repair(batches: Iterator) -> Iterator:
        found = (
            {"conv_id": head["conv_id"], "position": k, "role": role, "text": text}
            for head, own in _conversations(batches)
            for k, (role, text) in enumerate(own)
        )
        yield from _in_batches(found, names, kinds)

    return _beside_audits(rows, audit_rows).mapInArrow(repair, schema)


def with_digests(rows: DataFrame, audit_rows: DataFrame) -> DataFrame:
    """`audit_rows` with `repaired_sha256`, of the repaired `role:text` joined by newlines."""
    ship_package(rows.sparkSession)
    schema = T.StructType([*audit_rows.schema, T.StructField("repaired_sha256", T.StringType())])
    kinds, names = _arrow_kinds(schema), schema.names

    def digest(batches: Iterator) -> Iterator:
        import hashlib

        def found() -> Iterator[dict]:
            for head, own in _conversations(batches):
                sha = hashlib.sha256()
                for k, (role, text) in enumerate(own):
                    line = f"{role}:{text}" if k == 0 else f"\n{role}:{text}"
                    sha.update(line.encode("utf-8", "surrogatepass"))
                yield {**head, "repaired_sha256": sha.hexdigest()}

        yield from _in_batches(found(), names, kinds)

    return _beside_audits(rows, audit_rows).mapInArrow(digest, schema)
