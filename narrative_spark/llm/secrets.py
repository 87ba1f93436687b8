"""Operator 2: secret scan with corpus-wide ownership frequency, with SQL functions only.

Patterns propose candidates; each candidate's value is hashed, and the corpus counts in how many repositories and under how
many owners the hash stands. A value that many owners carry is a copied example; one that a single owner has in a few
repositories looks live. Base kinds (assign, access, hex) always stay; candidates of the further kinds
become spans only where ownership makes them look live.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrative_spark.llm import spans
from narrative_spark.llm.common import join_dealt, materialize, text_or_empty, unused

BASE = ("assign", "access", "hex")
MORE = ("prefixed", "jwt", "pem", "opaque")
#: A value under more owners, or in more repositories, is an example.
MAX_OWNERS, MAX_REPOS = 1, 3
ASSIGN = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: The same matches as of AKIA[A-Z0-9]+ and [0-9a-f]+ with their least lengths: both take a whole run from its first place.
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
PREFIXED = r"(?<![A-Za-z0-9_-])(?:gh[pousr]_|glpat-|xox[abprs]-|sk-|sk_live_|rk_live_|pypi-|npm_|AIza|SG\.)[A-Za-z0-9_.-]{16,}+"
JWT = r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"
PEM = r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
OPAQUE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{32,}+={0,2}(?![A-Za-z0-9+/_=-])"
PLACEHOLDER = r"(?i)example|changeme|placeholder|dummy|sample|your|xxxx|0000|1234567|test|<|\*\*\*"


def _value(kind: str, found: Column) -> Column:
    return F.regexp_extract(found, ASSIGN, 1) if kind == "assign" else found


def _candidates(text: Column) -> list[tuple[str, Column]]:
    mixed = lambda x: x.rlike("[0-9].*[0-9]") & x.rlike("[a-z]") & x.rlike("[A-Z]")
    return [
        ("assign", F.filter(spans.matches(text, ASSIGN, text.rlike("[:=]")), lambda s: F.length(_value("assign", s["text"])) >= 6)),
        ("access", spans.matches(text, ACCESS, text.contains("AKIA"))),
        ("hex", spans.matches(text, HEX, F.lit(True))),
        ("prefixed", spans.matches(text, PREFIXED, text.rlike("_|-|AIza|SG\\."))),
        ("jwt", spans.matches(text, JWT, text.contains("eyJ"))),
        ("pem", spans.matches(text, PEM, text.contains("PRIVATE KEY-----"))),
        ("opaque", F.filter(spans.matches(text, OPAQUE, text.rlike("[0-9]")), lambda s: mixed(s["text"]))),
    ]


def propose(docs: DataFrame, text_col: str, out: str) -> DataFrame:
    """docs with an array out of candidates: rank (place of the kind), kind, start, end, hash, plain (a placeholder or a value of few signs)."""
    found, held = _candidates(text_or_empty(text_col)), unused([*docs.columns, out], "secrets__kinds")

    def rows(rank: int, kind: str, spans_: Column) -> Column:
        def row(s: Column) -> Column:
            value = _value(kind, s["text"])
            plain = value.rlike(PLACEHOLDER) | (F.size(F.array_distinct(F.split(value, ""))) < 8)
            return F.struct(F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.sha2(value, 256).alias("hash"), plain.alias("plain"))

        return F.transform(spans_, row)

    made = docs.withColumn(held, F.struct(*[rows(k, kind, x).alias(kind) for k, (kind, x) in enumerate(found)]))
    base, more = (F.concat(*[F.col(held)[kind] for kind in some]) for some in (BASE, MORE))
    return made.select(*docs.columns, F.concat(base, spans.outside(more, base)).alias(out))


def ownership(candidates: DataFrame) -> DataFrame:
    """hash, n_rows, n_repos, n_owners from rows of hash, owner, repo; counted in three steps, so that no key gathers its rows."""
    repos = candidates.groupBy("hash", "owner", "repo").agg(F.count(F.lit(1)).alias("rows"))
    owners = repos.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repos"), F.sum("rows").alias("rows"))
    return owners.groupBy("hash").agg(F.sum("rows").alias("n_rows"), F.sum("repos").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"))


def find(docs: DataFrame, owner_col: str, repo_col: str, text_col: str = "text", result: str = "secrets", keep: list[str] | None = None, max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """docs (the columns in keep, or all) with an array result: kind, start, end, hash, n_repos, n_owners, live, by start, then kind.

    Null and empty texts have no spans; very long texts, words and lists of spans are read whole, in time near their length; spans
    that start at one place come in the order of BASE and MORE; a null owner or repository counts as one of its own; repeated rows
    are handled each for itself and count as one repository; an empty table gives an empty result; other columns pass through
    whatever their names, but result must be a new one.
    """
    carried = docs.columns if keep is None else keep
    row, owner, repo = (unused([*docs.columns, result], f"secrets__{x}") for x in ("row", "owner", "repo"))
    named = docs.withColumns({row: F.monotonically_increasing_id(), owner: F.col(owner_col).cast("string"), repo: F.col(repo_col).cast("string")})
    proposed = materialize(propose(named, text_col, result).select(*carried, row, owner, repo, result), "secrets")
    each = proposed.select(F.col(row).alias("row"), F.col(owner).alias("owner"), F.col(repo).alias("repo"), F.explode(result).alias("s")).select("row", "owner", "repo", "s", F.col("s.hash").alias("hash"))
    known = materialize(ownership(each.select("hash", "owner", "repo")), "owners")
    each = join_dealt(each.select("row", "s", "hash"), known, "hash", "n_rows", F.col("row"), "inner")
    live = (F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos) & ~F.col("s.plain")
    kept = each.withColumn("live", live).where((F.col("s.rank") < len(BASE)) | F.col("live"))
    one = F.struct("s.start", "s.rank", "s.end", "s.kind", "s.hash", "n_repos", "n_owners", "live")
    # A row's spans are bounded by its text.
    by_row = kept.groupBy(F.col("row").alias(f"{row}_of")).agg(F.sort_array(F.collect_list(one)).alias(f"{row}_found"))
    shown = F.transform(F.coalesce(f"{row}_found", F.array().cast(by_row.schema[f"{row}_found"].dataType)), lambda s: F.struct(*[s[k].alias(k) for k in ("kind", "start", "end", "hash", "n_repos", "n_owners", "live")]))
    return proposed.drop(owner, repo, result).join(by_row, F.col(row) == F.col(f"{row}_of"), "left").select(*carried, shown.alias(result))
