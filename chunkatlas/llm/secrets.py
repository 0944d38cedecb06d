"""Secret scans in DataFrame operations only: pattern spans, and corpus-wide ownership of their values.

A value that many owners hold is a copied example; one that few owners hold, in few repositories, looks
like a live credential. Values without a keyword become spans only if they look live in that sense.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, small_side
from .packing import packed, unpacked

#: The base patterns, in the order that ties keep. The first one's value is group 2.
PATTERNS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
)
#: Runs that may be credentials without a keyword: letters and digits mixed.
FREE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{20,}"
#: They need so many digits, in so many groups, and a piece of so many letters and digits in a row, which paths,
#: dates and words that are joined by strokes lack.
FREE_DIGITS, FREE_GROUPS, FREE_PIECE = 4, 3, 16
KINDS = (*[p[0] for p in PATTERNS], "owned")
#: A value of more distinct owners, repositories or rows than these is a copied example.
MOST_OWNERS, MOST_REPOSITORIES, MOST_ROWS = 2, 4, 100

_MATCH = "array<struct<kind:int,gap:int,size:int,hash:string>>"


def matches(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0,
            wanted: Callable[[Column], Column] | None = None) -> Column:
    """Leftmost non-overlapping matches in order: (kind, gap, size, hash), in code points.

    gap is the length of the text between the match before and this one; after the last match comes one entry
    without a size. hash is null if the value is shorter than ``least`` or not ``wanted``. Each array is
    computed once per text, so the work is linear in the matches.
    """
    def entry(gap: Column, size: Column, value: Column) -> Column:
        good = F.length(value) >= least
        # The values themselves are credentials, so only their hashes are kept.
        kept = F.when(good & wanted(value) if wanted else good, F.sha2(value, 256))
        return F.struct(F.lit(kind).alias("kind"), gap.alias("gap"), size.alias("size"), kept.alias("hash"))

    pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if group:
        sized = F.zip_with(pieces, found, lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m).alias("size")))
        out = F.zip_with(sized, F.regexp_extract_all(text, F.lit(pattern), F.lit(group)),
                         lambda s, value: entry(s["gap"], s["size"], value))
    else:
        out = F.zip_with(pieces, found, lambda gap, m: entry(F.length(gap), F.length(m), m))
    return F.when(text.rlike(pattern), out.cast(_MATCH)).otherwise(F.array().cast(_MATCH))


def _random_looking(value: Column) -> Column:
    return ((F.length(F.regexp_replace(value, "[^0-9]+", "")) >= FREE_DIGITS)
            & (F.size(F.regexp_extract_all(value, F.lit("[0-9]+"), F.lit(0))) >= FREE_GROUPS)
            & value.rlike(f"[A-Za-z0-9+=]{{{FREE_PIECE},}}"))


def _candidates(text: Column) -> Column:
    return F.concat(*[matches(text, pattern, i, group, least) for i, (_, pattern, group, least) in enumerate(PATTERNS)],
                    matches(text, FREE, len(PATTERNS), wanted=_random_looking))


def ownership(found: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repositories, n_rows) of rows (hash, owner, repository, row).

    Repeats are removed in the tasks before each exchange, so a value that a third of all rows holds
    moves once per row that has it, and once per task from there on. Null owners count as one owner.
    """
    single = found.groupBy("hash", "owner", "repository", "row").agg(F.count(F.lit(1)).alias("n"))
    pairs = single.groupBy("hash", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
    per_owner = pairs.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n_repositories"), F.sum("n").alias("n"))
    return per_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"),
                                         F.sum("n_repositories").alias("n_repositories"), F.sum("n").alias("n_rows"))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source",
         repository: Column | None = None, most_owners: int = MOST_OWNERS,
         most_repositories: int = MOST_REPOSITORIES, most_rows: int = MOST_ROWS,
         keep: list[Column] | None = None) -> DataFrame:
    """(key, found): per row all spans, sorted by start and kind, each with owners, repositories, rows, live.

    ``live`` is true if the value's hash has at most ``most_owners`` distinct owners, ``most_repositories``
    distinct repositories and ``most_rows`` rows in the whole corpus. Base spans stay whatever their
    ownership; a span of the kind ``owned`` is there only if it is live and no base span overlaps it. ``before``
    of a span is the furthest end of the spans before it, or 0.
    Null and empty texts have no spans; repeated rows are judged row by row alike. ``repository`` is the
    key if it isn't given; ``keep`` lists other columns to return in the key's place, under names that do not
    begin with ``_``.

    The rows' matches, without the texts, are written once; the row number given there joins the
    ownership back. A value that many rows hold is a skewed join key, which adaptive execution splits.
    """
    repository = F.col(key).cast("string") if repository is None else repository
    rows = docs.select(*([F.col(key)] if keep is None else keep), F.col(owner).cast("string").alias("_owner"),
                       repository.alias("_repository"), _candidates(F.coalesce(F.col(text), F.lit(""))).alias("_matches"))
    rows = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "secrets")
    found = _judged(rows, most_owners, most_repositories, most_rows)
    empty = F.array().cast(found.schema["found"].dataType)
    return (rows.join(found, "_row", "left").withColumn("found", F.coalesce("found", empty))
            .drop("_row", "_owner", "_repository", "_matches"))


def _judged(rows: DataFrame, most_owners: int, most_repositories: int, most_rows: int) -> DataFrame:
    """_row and found of the rows that have spans. Positions are running sums over a text's matches."""
    entries = rows.where(F.size("_matches") > 0).select(
        F.col("_row").alias("row"), F.col("_owner").alias("owner"), F.col("_repository").alias("repository"),
        F.posexplode("_matches").alias("pos", "m")).select("row", "owner", "repository", "pos", "m.*")
    so_far = Window.partitionBy("row", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    single = (entries.withColumn("end", F.sum(F.col("gap") + F.coalesce("size", F.lit(0))).over(so_far).cast("int"))
              .where("hash IS NOT NULL").withColumn("start", F.col("end") - F.col("size"))
              .select("row", "owner", "repository", "start", "kind", "end", "hash"))
    free, live = len(PATTERNS), (F.col("n_owners") <= most_owners) & (
        F.col("n_repositories") <= most_repositories) & (F.col("n_rows") <= most_rows)
    judged = single.join(ownership(single), "hash").withColumn("live", live)
    in_text = Window.partitionBy("row").orderBy("start", "kind")
    earlier = in_text.rowsBetween(Window.unboundedPreceding, -1)
    # A frame up to the end is computed anew for each row, so what comes later is read backwards.
    later = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    base = F.col("kind") < free
    apart = (F.coalesce(F.max(F.when(base, F.col("end"))).over(earlier), F.lit(0)) <= F.col("start")) & F.coalesce(
        F.min(F.when(base, F.col("start"))).over(later) >= F.col("end"), F.lit(True))
    kept = judged.withColumn("apart", apart).where(base | (F.col("live") & F.col("apart")))
    kept = kept.withColumn("before", F.coalesce(F.max("end").over(earlier), F.lit(0)))
    return kept.groupBy(F.col("row").alias("_row")).agg(F.sort_array(F.collect_list(F.struct(
        "start", "kind", "end", "hash", "n_owners", "n_repositories", "n_rows", "live", "before"))).alias("found"))


def redacted(docs: DataFrame, key: str = "doc_id", text: str = "text", size: str = "n_chars", owner: str = "source",
             repository: Column | None = None, **options) -> DataFrame:
    """``docs`` with all found spans in its texts replaced, and ``size`` counted anew where one was.

    Only rows with spans are joined back, by key and a digest of the text, so equal keys with different
    texts keep apart. Texts stay where they are if the table of spans is measured to be small. All columns of
    ``docs`` stay, whatever their names.
    """
    digest = F.xxhash64(text)
    own = F.col(key).cast("string") if repository is None else repository
    slim = docs.select(F.col(key).alias("key"), digest.alias("digest"), F.col(text).alias("text"),
                       F.col(owner).alias("owner"), own.alias("repository"))
    found = (scan(slim, "key", "text", "owner", F.col("repository"), keep=[F.col("key"), F.col("digest")], **options)
             .where(F.size("found") > 0).dropDuplicates(["key", "digest"]).withColumnRenamed("key", "_key")
             .withColumnRenamed("digest", "_digest"))
    rows = packed(docs, text, key=F.col(key), digest=digest)
    joined = rows.join(small_side(found), F.col("key").eqNullSafe(F.col("_key")) & (F.col("digest") == F.col("_digest")),
                       "left").withColumn("clean", redact(F.col("text"), F.col("found")))
    counted = {size: F.when(F.size("found") > 0, F.length("text")).otherwise(F.col(f"_doc.`{size}`"))}
    return unpacked(joined.drop("text").withColumnRenamed("clean", "text"), docs, text,
                    **(counted if size in docs.columns else {}))


def listed(found: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined, in their order."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, found: Column, mark: str = "<secret>") -> Column:
    """The text with every found span, or run of overlapping spans, replaced by ``mark``.

    ``found`` is as ``scan`` gives it, or null. The pieces between spans are cut from the text's characters, which
    each come into one piece, and joined once.
    """
    def pieces(parts: Column) -> Column:
        chars, spans = parts["chars"], parts["spans"]
        kept = F.transform(spans, lambda s: F.when(s["start"] >= s["before"], F.concat(
            F.array_join(F.slice(chars, s["before"] + 1, s["start"] - s["before"]), ""), F.lit(mark))).otherwise(""))
        end = F.array_max(F.transform(spans, lambda s: s["end"]))
        return F.concat(F.array_join(kept, ""), F.array_join(F.slice(chars, end + 1, F.size(chars)), ""))

    # A one-element array binds the characters once for all lambdas within.
    bound = F.array(F.struct(F.split(text, "").alias("chars"), found.alias("spans")))
    return F.when(F.size(found) > 0, F.get(F.transform(bound, pieces), F.lit(0))).otherwise(text)
