"""Secret scan: candidates by pattern, judged by how widely their values are owned across the corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import ROW_KEY, keyed, let, stored

#: The base patterns, in the order in which kinds are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
#: Runs that may be a credential without any name before them.
OPAQUE = r"[A-Za-z0-9+/_-]{24,}"
KINDS = ("assign", "access", "hex", "opaque")
SPANS = "array<struct<kind:int,start:bigint,end:bigint,value:string>>"


def _matches(text: Column, pattern: str, kind: int, keep, value=lambda m: m) -> Column:
    """(kind, start, end, value) of the leftmost, non-overlapping matches that ``keep`` accepts.

    The text between matches and the matches alternate; their lengths, in code points, add up
    to the positions. Texts without a match stop at the ``rlike``.
    """
    def place(gaps, found):
        walked = F.aggregate(found, F.struct(F.lit(0).cast("bigint").alias("at"), F.lit(0).alias("i"), F.array().cast(SPANS).alias("out")),
            lambda acc, m: let(acc["at"] + F.char_length(F.get(gaps, acc["i"])), lambda start: F.struct(
                (start + F.char_length(m)).alias("at"), (acc["i"] + 1).alias("i"),
                F.when(keep(m), F.concat(acc["out"], F.array(F.struct(
                    F.lit(kind).alias("kind"), start.alias("start"), (start + F.char_length(m)).alias("end"),
                    value(m).alias("value")))).cast(SPANS)).otherwise(acc["out"]).alias("out"))))
        return walked["out"]

    return F.when(text.rlike(pattern), let(F.split(text, pattern, -1), lambda gaps: let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: place(gaps, found)))).otherwise(F.array().cast(SPANS))


def candidates(text: Column) -> Column:
    """All candidate spans of a text: the three base kinds and opaque runs."""
    group = lambda m: F.regexp_extract(m, f"^{ASSIGN}$", 2)
    mixed = lambda m: m.rlike("[a-z]") & m.rlike("[A-Z]") & m.rlike("[0-9]")
    plain = F.coalesce(text, F.lit(""))
    return let(plain, lambda t: F.concat(
        _matches(t, ASSIGN, 0, lambda m: F.length(group(m)) >= 8, group),
        _matches(t, ACCESS, 1, lambda m: F.length(m) >= 16),
        # runs below 32 characters never pass, and dropping them early changes no other match
        _matches(t, r"(?<![0-9a-f])[0-9a-f]{32,}", 2, lambda m: F.length(m) >= 32),
        _matches(t, OPAQUE, 3, mixed)))


def ownership(found: DataFrame, owner: str, repo: str, widely: int = 3) -> DataFrame:
    """(digest, n_rows, n_repos, n_owners, live): how widely each candidate value is spread.

    Rows are first reduced to (value, owner, repo), so a value that a third of all rows hold
    costs one row per owner and task. ``live``: fewer than ``widely`` owners hold the value.
    """
    pairs = found.groupBy("digest", owner, repo).agg(F.count("*").alias("n"))
    return pairs.groupBy("digest").agg(
        F.sum("n").alias("n_rows"), F.count_distinct(F.coalesce(F.col(repo), F.lit(""))).alias("n_repos"),
        F.count_distinct(F.coalesce(F.col(owner), F.lit(""))).alias("n_owners")).withColumn("live", F.col("n_owners") < widely)


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text", owner: Column | str = "source",
         repo: Column | str = "source", widely: int = 3) -> DataFrame:
    """One row per row of ``docs``: id and ``spans`` (kind, start, end, base, digest, live, n_owners, n_repos).

    Base kinds are always kept. An opaque run is kept when it lies in no base span and is live:
    its value is owner-specific over the whole corpus. NULL texts and texts without a match have
    no spans; NULL owners and repositories count as one owner each; repeated rows are alike.
    Positions count code points, ends are exclusive. Values leave the operator as SHA-256 only.
    """
    named = lambda c: F.col(c) if isinstance(c, str) else c
    rows = keyed(docs.select(F.col(id), F.col(text), named(owner).cast("string").alias("__owner"), named(repo).cast("string").alias("__repo")), id, text)
    found = stored(rows.select(*ROW_KEY, "__owner", "__repo", F.explode(candidates(F.col(text))).alias("c")).select(
        *ROW_KEY, "__owner", "__repo", "c.kind", "c.start", "c.end", F.sha2("c.value", 256).alias("digest")))
    judged = found.drop("__owner", "__repo").distinct().join(ownership(found, "__owner", "__repo", widely), "digest")
    per_row = judged.groupBy(*ROW_KEY).agg(F.array_sort(F.collect_set(F.struct(
        "start", "kind", "end", "digest", "live", "n_owners", "n_repos"))).alias("all"))
    base = F.filter("all", lambda s: s["kind"] < 3)
    kept = per_row.select(*ROW_KEY, let(base, lambda b: F.filter("all", lambda s: (s["kind"] < 3) | (
        s["live"] & ~F.exists(b, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"]))))).alias("spans"))
    empty = F.array().cast(kept.schema["spans"].dataType)
    return rows.select(id, *ROW_KEY).join(kept, ROW_KEY, "left").select(id, F.coalesce("spans", empty).alias("spans"))


def digest_text(spans: Column) -> Column:
    """``kind:start:end`` of spans in order, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def summary(scanned: DataFrame, id: str = "doc_id") -> DataFrame:
    """Counts, digest of the base spans, all spans as text, and what ownership says of them."""
    base = F.filter("spans", lambda s: s["kind"] < 3)
    count = lambda test: F.size(F.filter("spans", test)).cast("bigint")
    return scanned.select(
        id, count(lambda s: s["kind"] == 0).alias("n_assign"), count(lambda s: s["kind"] == 1).alias("n_access"),
        count(lambda s: s["kind"] == 2).alias("n_hex"), F.sha2(digest_text(base), 256).alias("base_sha256"),
        digest_text(F.col("spans")).alias("spans"), count(lambda s: s["live"]).alias("n_live"),
        count(lambda s: ~s["live"]).alias("n_example"))
