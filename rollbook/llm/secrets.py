"""Secret scans that weigh candidates by who owns them across the whole corpus, with DataFrame functions only.

``scan`` finds the spans of every kind in whole texts. ``ownership`` counts, for the hash of each candidate value, the distinct
repositories and owners that carry it: a value seen under many owners is a copied example, one that stays with few is live-looking.
``judge`` joins that verdict back and gives each row its spans: those of the base kinds always, those of the further kinds when live-looking.

Cases: a null or empty text has no spans; null owners or repositories count as one owner or repository without a name; repeated rows keep
their own spans and do not raise the counts; a null id is a value like another; an empty table gives an empty table; input columns
other than the named ones are not read. The hot values (one example in a third of all rows) are reduced by
partial aggregates, first to (value, repository, owner), then to the value; the join back is a plain join that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import match_spans, stored

#: Base kinds in the order of the result: pattern, group that holds the value, and its least length.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = {"assign": (ASSIGN, 2, 8), "access": (r"AKIA[A-Z0-9]+", 0, 16), "hex": (r"[0-9a-f]{32,}", 0, 32)}
#: Further kinds: the value is the group; nothing is required of its length beyond the pattern.
FURTHER = {
    "bearer": (r"(?i:bearer)\x20+([A-Za-z0-9_.~+/-]{20,}=*)", 1, 20),
    "jwt": (r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 26),
    "key_block": (r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----[A-Za-z0-9+/=\s]*+(?:-----END [A-Z ]{0,20}PRIVATE KEY-----)?", 0, 30),
    "url_login": (r"[a-z][a-z0-9+.-]{1,15}://[^\s:/@]{1,64}:([^\s/@]{6,128})@", 1, 6),
    "prefixed": (r"(?:gh[pousr]_|sk_live_|rk_live_|xox[abprs]-|glpat-|AIza)[A-Za-z0-9_-]{16,}", 0, 20),
}
KINDS = BASE | FURTHER
#: A text that holds none of these holds no span of any kind.
GATES = {"assign": r"(?i)passw|secret|token|api_?key", "access": "AKIA", "hex": r"[0-9a-f]{32}", "bearer": r"(?i)bearer", "jwt": "eyJ", "key_block": "PRIVATE KEY", "url_login": r"://[^\s/@]{1,200}@",
         "prefixed": r"gh[pousr]_|[sr]k_live_|xox[abprs]-|glpat-|AIza"}
SPAN = "array<struct<start:bigint,end:bigint,kind:string,value:string>>"
#: A value of more owners or repositories than this is a copied example.
MAX_OWNERS, MAX_REPOSITORIES = 2, 4


def spans_of(text: Column, kind: str) -> Column:
    """The spans of one kind: leftmost matches without overlap; those whose value is too short are dropped after matching."""
    pattern, group, least = KINDS[kind]
    value = lambda m: m["hit"] if group == 0 else F.regexp_extract(m["hit"], pattern, group)
    found = F.transform(match_spans(text, F.lit(pattern)), lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), F.lit(kind).alias("kind"), value(m).alias("value")))
    return F.when(text.rlike(GATES[kind]), F.filter(found, lambda m: F.length(m["value"]) >= least)).otherwise(F.array().cast(SPAN))


def scan(docs: DataFrame, row_key: str = "doc_id", text: str = "text", keep=()) -> DataFrame:
    """``row_key``, the columns of ``keep`` and ``found``: the spans of all kinds in whole texts, sorted by start and then kind as listed."""
    rank = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    body = F.coalesce(F.col(text), F.lit(""))
    any_ = body.rlike("|".join(GATES[k] if "(?i)" not in GATES[k] else f"(?i:{GATES[k].replace('(?i)', '')})" for k in KINDS))
    # the gates see only texts that pass all of them together; without a match the text is cut to nothing before the kinds are looked at
    gated = docs.select(F.col(row_key), *keep, F.when(any_, body).otherwise("").alias("_body"))
    lists = gated.select(row_key, *keep, *[spans_of(F.col("_body"), k).alias(f"_{k}") for k in KINDS])
    every = F.flatten(F.array(*[f"_{k}" for k in KINDS]))
    order = F.sort_array(F.transform(every, lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value"))))
    return lists.select(row_key, *keep, F.transform(order, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value"))).alias("found"))


def candidates(scanned: DataFrame, *columns) -> DataFrame:
    """One row for each span: ``columns``, the span and the hash of its value."""
    return scanned.filter(F.size("found") > 0).select(*columns, F.explode("found").alias("span")).withColumn("value_hash", F.sha2("span.value", 256))


def ownership(cands: DataFrame, repository: str, owner: str) -> DataFrame:
    """Per value hash: distinct repositories and owners, and whether the value is live-looking."""
    own = cands.groupBy("value_hash", F.coalesce(F.col(repository).cast("string"), F.lit("")).alias("_repo"), F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("_owner")).agg(F.lit(1).alias("_one"))
    # owners per value: a value of n owners has n rows after the second grouping, so the third sees small counts
    repos = own.groupBy("value_hash").agg(F.count(F.lit(1)).alias("n_repositories"))
    owners = own.groupBy("value_hash", "_owner").agg(F.lit(1).alias("_one")).groupBy("value_hash").agg(F.count(F.lit(1)).alias("n_owners"))
    return repos.join(owners, "value_hash").withColumn("live", (F.col("n_owners") <= MAX_OWNERS) & (F.col("n_repositories") <= MAX_REPOSITORIES))


def judge(scanned: DataFrame, row_key: str, repository: str, owner: str) -> DataFrame:
    """``row_key, spans``: each row's spans with ``live``; spans of further kinds only where live-looking. Rows without spans are absent."""
    cands = candidates(scanned, row_key, repository, owner)
    verdict = ownership(cands, repository, owner)
    each = cands.select(row_key, "value_hash", F.struct("span.start", "span.end", "span.kind").alias("span")).join(verdict, "value_hash")
    each = each.filter(F.col("live") | F.col("span.kind").isin(*BASE))
    rank = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    one = F.struct(F.col("span.start").alias("start"), rank[F.col("span.kind")].alias("rank"), F.col("span.end").alias("end"), F.col("span.kind").alias("kind"), "live", "n_owners", "n_repositories")
    # rows of one key have one text, so equal spans are repeats of it
    return each.groupBy(row_key).agg(F.sort_array(F.collect_set(one)).alias("spans"))


def find_secrets(docs: DataFrame, owner: Column, repository: Column, text: str = "text", keep=("doc_id",)) -> DataFrame:
    """Every row: the columns of ``keep``, ``found`` (all spans) and ``spans`` (those that stay, with the verdict on their value).

    Rows are known by a checksum and length of the text, so equal texts share one list. The texts are scanned once; only spans are stored and joined."""
    key = F.struct(F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("h"))
    rows = docs.select(*keep, F.col(text).alias("_text"), owner.alias("_own"), repository.alias("_repo"), key["h"].alias("_key"))
    scanned = stored(scan(rows, "_key", "_text", [*keep, "_own", "_repo"]))
    some = scanned.filter(F.size("found") > 0)
    judged = judge(some, "_key", "_repo", "_own")
    none = F.array().cast(judged.schema["spans"].dataType)
    return some.join(judged, "_key", "left").select(*keep, "found", F.coalesce("spans", none).alias("spans")).unionByName(
        scanned.filter(F.size("found") == 0).select(*keep, "found", none.alias("spans")))


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span replaced by ``mark``. Overlapping spans merge. ``spans`` is sorted by start."""
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).cast("bigint").alias("at"))
    piece = lambda a, b: F.substr(text, (a + 1).cast("int"), (b - a).cast("int"))
    step = lambda z, s: F.when(s["start"] >= z["at"], F.struct(F.concat(z["out"], F.array(F.concat(piece(z["at"], s["start"]), F.lit(mark)))).alias("out"), s["end"].alias("at"))).otherwise(
        F.struct(z["out"].alias("out"), F.greatest(z["at"], s["end"]).alias("at")))
    return F.aggregate(spans, start, step, lambda z: F.concat(F.array_join(z["out"], ""), F.substr(text, (z["at"] + 1).cast("int"))))
