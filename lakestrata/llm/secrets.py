"""Secrets in texts: strong patterns, and weak parts that count only together."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.llm.common import stored, whole

# Fixed patterns of the three base kinds: (kind, pattern, group, its least characters).
BASE = (
    (
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
# Weak parts: an account or key name, something like a secret, where to use it.
WEAK = (
    (
        "part_id",
        r"""(?i)(user|username|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]+)""",
        2,
        3,
    ),
    ("part_secret", r"""(?i)(pwd|pass|pin|auth|credential|private_?key)["']?\x20*[:=]\x20*["']?([^\x20\x09-\x0D"'<>,;]+)""", 2, 4),
    ("part_endpoint", r"""(?i)(https?|ftp|ssh|jdbc:[a-z]+|postgres|mysql|redis|amqp|mongodb)://([A-Za-z0-9._~:/?#@!$&()*+=%-]+)""", 2, 4),
)
KINDS = tuple(kind for kind, *_ in (*BASE, *WEAK))
# What a part counts as when others look for its complement.
IDENTIFIES = ("access", "part_id")
KEEPS_SECRET = ("assign", "hex", "part_secret")
#: Characters between the starts of parts that belong to one scope.
SCOPE = 200


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per document: doc_id, spans; spans are (start, kind_at, end, kind), sorted.

    Places count code points, the end is exclusive, ``kind_at`` is the kind's
    place in ``KINDS``. Matches of a base kind are leftmost and do not overlap;
    those that are too short are dropped after matching. Weak parts are reported
    only when complementary parts start within ``scope`` characters of them, and
    no base match overlaps them: an identifier needs a secret, a secret an
    identifier, an endpoint both, strong or weak. Null and empty texts have no
    spans; repeated rows each keep their row; an empty table gives no rows;
    other columns are not looked at.

    The text is left behind at once: what matches and the gaps between matches
    are kept as lengths. Parts are linked by a window over the places of one
    document, whose frame is the scope, so no pairs are made.
    """
    text = F.col("text")
    found = []
    for kind, pattern, group, _ in (*BASE, *WEAK):
        # The gaps between matches give their places.
        lengths = F.arrays_zip(
            F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
            F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length).alias("size"),
            F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.length).alias("value"),
        )
        found.append(F.when(text.rlike(pattern), lengths).alias(kind))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), whole(text_col).alias("text")
    )
    rows = stored(rows.select("row", "doc_id", *found), "secret-lengths")

    parts = None
    for at, (kind, _, _, least) in enumerate((*BASE, *WEAK)):
        each = rows.filter(F.col(kind).isNotNull()).select("row", F.posexplode(kind).alias("nth", "part"))
        each = each.filter("part.size is not null").select(
            "row", F.lit(at).alias("kind_at"), "nth", "part.gap", "part.size", (F.col("part.value") >= least).alias("long")
        )
        parts = each if parts is None else parts.unionByName(each)
    upto = Window.partitionBy("row", "kind_at").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("size")).over(upto)
    placed = parts.withColumn("end", end).filter("long")
    placed = placed.select("row", "kind_at", (F.col("end") - F.col("size")).alias("start"), "end")
    placed = placed.withColumn("kind", F.array(*[F.lit(k) for k in KINDS])[F.col("kind_at")])

    base = F.col("kind_at") < len(BASE)
    by_start = Window.partitionBy("row").orderBy("start", "kind_at")
    past = F.max(F.when(base, F.col("end"))).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    ahead = F.min(F.when(base, F.col("start"))).over(by_start.rowsBetween(1, Window.unboundedFollowing))
    apart = (F.coalesce(past, F.lit(0)) <= F.col("start")) & (F.coalesce(ahead, F.col("end")) >= F.col("end"))
    placed = placed.withColumn("apart", base | apart).filter("apart")
    near = Window.partitionBy("row").orderBy("start").rangeBetween(-scope, scope)
    named = F.max(F.col("kind").isin(*IDENTIFIES)).over(near)
    secret = F.max(F.col("kind").isin(*KEEPS_SECRET)).over(near)
    linked = (
        F.when(F.col("kind") == "part_id", secret)
        .when(F.col("kind") == "part_secret", named)
        .when(F.col("kind") == "part_endpoint", named & secret)
        .otherwise(F.lit(True))
    )
    kept = placed.withColumn("linked", linked).filter("linked")
    spans = kept.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind_at", "end", "kind"))).alias("spans"))
    none = F.array().cast("array<struct<start:bigint,kind_at:int,end:bigint,kind:string>>")
    return rows.select("row", "doc_id").join(spans, "row", "left").select("doc_id", F.coalesce("spans", none).alias("spans"))
