"""Secrets in texts, told apart by who owns them across the corpus.

Candidates are key assignments, access keys, hexadecimal strings and other
long mixed tokens.  Each candidate's value is hashed, and the hashes are
aggregated over the corpus: in how many documents, repositories and owners a
value stands.  A value that many owners have, or that lies in many
repositories of few owners, a few documents in each, is a copied example; one
that few have, and whose characters are varied, looks live.  Mixed tokens are
reported only if they look live.

Built-in DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetrail.llm.common import checkpointed
from tunetrail.llm.spans import digest, with_matches

# The patterns of the base kinds; letters of the names in ``assign`` in either case.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: Other tokens: long runs that mix digits, capitals and small letters.
TOKEN = r"[A-Za-z0-9+/_-]{24,}"

KINDS = ("assign", "access", "hex", "token")
LEAST_VALUE = 6
#: A value of at least so many owners is a copied example, and so is one of at least so many repositories that has no
#: more than so many documents in each, on average: a credential in use fills the files of the one that uses it.
EXAMPLE_OWNERS, EXAMPLE_REPOS, DOCS_A_REPO = 3, 5, 3
#: A live-looking value has at least so many different characters.
LEAST_VARIETY = 8


def candidates(docs: DataFrame, carry: list[str], text_col: str = "text") -> DataFrame:
    """``carry`` and ``spans``: array of (start, end, kind, value), base kinds and tokens."""
    text = F.col(f"`{text_col}`")
    src = docs.select(*carry, text.alias("_text"))
    t = F.col("_text")
    found = with_matches(src, "_text", {k: (p, t.rlike(p), g) for k, p, g in (("assign", ASSIGN, 2), ("access", ACCESS, 0), ("hex", HEX, 0), ("token", TOKEN, 0))}, [*carry])
    ok = {"assign": lambda x: F.length(x["group"]) >= LEAST_VALUE,
          "token": lambda x: x["match"].rlike("[0-9]") & x["match"].rlike("[A-Z]") & x["match"].rlike("[a-z]")}

    def of(kind: str) -> Column:
        rows = F.filter(F.col(kind), ok[kind]) if kind in ok else F.col(kind)
        return F.transform(rows, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit(kind).alias("kind"), x["group"].alias("value")))

    return found.select(*carry, F.concat(*[of(k) for k in KINDS]).alias("spans"))


def ownership(values: DataFrame) -> DataFrame:
    """(hash, n_docs, n_repos, n_owners) from one row (hash, owner, repo) for each document that has the value.

    A null owner or repository is one of its own.  Counted from (hash, owner, repo) down, each step summed in the map
    tasks, so a value that fills a third of the corpus is a few rows per task."""
    each = values.groupBy("hash", "owner", "repo").agg(F.count(F.lit(1)).alias("n"))
    owners = each.groupBy("hash", "owner").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("repos"))
    return owners.groupBy("hash").agg(F.sum("n").alias("n_docs"), F.sum("repos").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"))


def scan_secrets(docs: DataFrame, owner: Column, repo: Column, example_owners: int = EXAMPLE_OWNERS, example_repos: int = EXAMPLE_REPOS, docs_a_repo: int = DOCS_A_REPO,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n_assign, n_access, n_hex, n_token, n_live, n_example, most_owners, most_repos, most_docs (long), base and spans (arrays of start, end, kind).

    ``base`` has the spans of the three base kinds; ``spans`` has also the tokens that look live.  n_live and n_example
    count the row's reported values that look live and that are copied examples; most_owners, most_repos and most_docs
    are the largest numbers of owners, repositories and documents that one of them has in the corpus.  Null and empty
    texts have none (0); null and repeated ids give a row each; a null owner or repository is one of its own.
    """
    src = docs.select(F.col(f"`{id_col}`").alias("_doc"), owner.cast("string").alias("_owner"), repo.cast("string").alias("_repo"), F.col(f"`{text_col}`").alias("_text"))
    scanned = candidates(src, ["_doc", "_owner", "_repo"], "_text")
    hashed = F.transform("spans", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"), F.sha2(x["value"].cast("binary"), 256).alias("hash"),
                                                     (F.size(F.array_distinct(F.split(x["value"], ""))) >= LEAST_VARIETY).alias("varied")))
    rows = checkpointed(scanned.select("_doc", "_owner", "_repo", hashed.alias("spans"), F.monotonically_increasing_id().alias("_row")))  # numbered once, then stored
    some = rows.where(F.size("spans") > 0)
    held = some.select("_row", F.col("_owner").alias("owner"), F.col("_repo").alias("repo"), F.explode(F.array_distinct(F.transform("spans", lambda x: x["hash"]))).alias("hash"))
    example = (F.col("n_owners") >= example_owners) | ((F.col("n_repos") >= example_repos) & (F.col("n_docs") <= docs_a_repo * F.col("n_repos")))
    owned = ownership(held).withColumn("example", example)
    judged = (some.select("_row", F.explode("spans").alias("x")).select("_row", "x.*").join(owned, "hash")
              .withColumn("live", ~F.col("example") & F.col("varied")).where((F.col("kind") != "token") | F.col("live"))
              .groupBy("_row").agg(F.collect_list(F.struct("start", "end", "kind")).alias("_all"),  # a document's own spans
                                   F.sum(F.col("live").cast("long")).alias("_live"), F.sum(F.col("example").cast("long")).alias("_example"),
                                   *[F.max(f"n_{x}").alias(f"_{x}") for x in ("owners", "repos", "docs")]))
    none = F.array().cast("array<struct<start:bigint,end:bigint,kind:string>>")
    spans = F.coalesce("_all", none)
    count = lambda k: F.size(F.filter(spans, lambda x: x["kind"] == k)).cast("long")
    return rows.drop("spans").join(judged, "_row", "left").select(
        F.col("_doc").alias(id_col), *[count(k).alias(f"n_{k}") for k in KINDS], F.coalesce("_live", F.lit(0)).cast("long").alias("n_live"), F.coalesce("_example", F.lit(0)).cast("long").alias("n_example"),
        *[F.coalesce(f"_{x}", F.lit(0)).cast("long").alias(f"most_{x}") for x in ("owners", "repos", "docs")],
        F.filter(spans, lambda x: x["kind"] != "token").alias("base"), spans.alias("spans"))


def span_digest(spans: Column) -> Column:
    return digest(spans, KINDS)
