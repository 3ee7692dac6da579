"""Linkage, grouping and component queries over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollgraph.operators import agreement as agr
from rollgraph.operators import scoring as sco
from rollgraph.operators.addresses import build_address_edges, with_canonical
from rollgraph.operators.components import cluster_pairs
from rollgraph.operators.grouping import group_similar as group_strings
from rollgraph.operators.index import business_nodes, name_index
from rollgraph.operators.similar import similar_values as find_similar
from rollgraph.plans import dedupe
from rollgraph.plans.fixtures import view
from rollgraph.plans.graph import group_addresses
from rollgraph.plans.registry import query

# Parts as records: candidates share brand and type, name and size are compared.
PARTS = agr.LinkSettings(
    comparisons=(
        agr.Comparison("name", term_frequency=True, similarity=0.9),
        agr.Comparison("size", term_frequency=True),
    ),
    rules=(("brand", "city"),),
    iterations=5,
)

# Weights to score with where the estimate itself is not the subject.
GIVEN = sco.Weights(
    prior=0.05,
    m={"name": (0.05, 0.15, 0.8), "size": (0.1, 0.9)},
    u={"name": (0.9, 0.06, 0.04), "size": (0.96, 0.04)},
)
GIVEN_NAMES = sco.Weights(prior=0.01, m={"name": (0.1, 0.9)}, u={"name": (0.95, 0.05)})
GIVEN_ADDRESSES = sco.Weights(
    prior=0.02,
    m={"address1": (0.2, 0.8), "city": (0.1, 0.9), "zip_code": (0.15, 0.85)},
    u={"address1": (0.99, 0.01), "city": (0.9, 0.1), "zip_code": (0.92, 0.08)},
)


def _integers(df: DataFrame) -> DataFrame:
    """Pair counts as bigint and scores to six places, for comparison."""
    out = df.withColumn("n_pairs", F.col("n_pairs").cast("bigint"))
    for c in ("match_probability", "tf_match_probability", "tf", "m", "u", "prior", "similarity"):
        if c in out.columns:
            out = out.withColumn(c, F.round(c, 6))
    return out


_PAIRS = """, pairs AS (
  SELECT l.brand, l.city, l.name AS nl, r.name AS nr, l.size AS sl, r.size AS sr,
         CASE WHEN l.name = r.name THEN 2
              WHEN jaro_winkler_similarity(l.name, r.name) >= 0.9 THEN 1 ELSE 0 END AS gamma_name,
         CASE WHEN l.size = r.size THEN 1 ELSE 0 END AS gamma_size
  FROM fx_link l JOIN fx_link r
    ON l.brand = r.brand AND l.city = r.city AND l.unique_id < r.unique_id),
grouped AS (
  SELECT brand, city, gamma_name, CASE WHEN gamma_name = 2 THEN nl END AS name,
         CASE WHEN gamma_name = 1 THEN least(nl, nr) END AS name_l,
         CASE WHEN gamma_name = 1 THEN greatest(nl, nr) END AS name_r,
         gamma_size, CASE WHEN gamma_size = 1 THEN sl END AS size, count(*) AS n_pairs
  FROM pairs GROUP BY ALL)"""


def _odds(weights: sco.Weights, tf: bool = False) -> str:
    """Match odds in SQL for ``GIVEN``-like weights."""
    out = f"({weights.prior!r} / (1 - {weights.prior!r}))"
    for c in weights.m:
        cases = " ".join(
            f"WHEN {at} THEN {m!r}::DOUBLE / {u!r}"
            for at, (m, u) in enumerate(zip(weights.m[c], weights.u[c]))
        )
        out += f" * CASE gamma_{c} {cases} ELSE 1 END"
        if tf:
            top = len(weights.m[c]) - 1
            out += (
                f" * CASE WHEN gamma_{c} = {top} THEN {weights.u[c][top]!r}::DOUBLE / tf_{c}.tf"
                " ELSE 1 END"
            )
    return out


def _probability(odds: str) -> str:
    return f"round(1 - 1 / (1 + ({odds})), 6)"


def _tf(view_name: str, column: str) -> str:
    return (
        f"LEFT JOIN (SELECT {column} AS v, count(*) / (SELECT count({column}) FROM {view_name})::DOUBLE "
        f"AS tf FROM {view_name} GROUP BY {column}) tf_{column} "
        f"ON tf_{column}.v = g.{column}"
    )


@query(
    "SELECT 0 AS rule, to_json([brand, city]) AS block, unique_id, filing_num, "
    "count(*) OVER w AS size, CAST(count(*) OVER w * (count(*) OVER w - 1) / 2 AS BIGINT) AS pairs "
    "FROM fx_link WINDOW w AS (PARTITION BY brand, city)",
    "fx_link",
)
def block_members(spark, sf) -> DataFrame:
    members = agr.block_members(view(spark, sf, "fx_link"), PARTS)
    return members.withColumn("pairs", F.col("pairs").cast("bigint"))


_ADDRESS_PAIRS = """, pairs AS (
  SELECT l.address1 AS al, l.city AS cl, l.zip_code AS zl,
         CASE WHEN l.address1 = r.address1 THEN 1 ELSE 0 END AS gamma_address1,
         CASE WHEN l.city = r.city THEN 1 ELSE 0 END AS gamma_city,
         CASE WHEN l.zip_code = r.zip_code THEN 1 ELSE 0 END AS gamma_zip_code
  FROM fx_address l JOIN fx_address r ON l.row_no < r.row_no
   AND (l.address1 = r.address1 OR l.city = r.city OR l.zip_code = r.zip_code)),
grouped AS (
  SELECT gamma_address1, CASE WHEN gamma_address1 = 1 THEN al END AS address1,
         gamma_city, CASE WHEN gamma_city = 1 THEN cl END AS city,
         gamma_zip_code, CASE WHEN gamma_zip_code = 1 THEN zl END AS zip_code,
         count(*) AS n_pairs
  FROM pairs GROUP BY ALL)"""


@query(_ADDRESS_PAIRS + " SELECT * FROM grouped", "fx_address")
def block_pairs_any_rule(spark, sf) -> DataFrame:
    """Candidates of three rules, each pair counted once."""
    return _integers(agr.agreement_groups(view(spark, sf, "fx_address"), dedupe.ADDRESSES))


@query(_PAIRS + " SELECT * FROM grouped", "fx_link")
def compare(spark, sf) -> DataFrame:
    return _integers(agr.agreement_groups(view(spark, sf, "fx_link"), PARTS))


@query(
    ", v AS (SELECT DISTINCT brand, city, name FROM fx_link) SELECT l.brand, l.city, l.name AS value_l, "
    "r.name AS value_r, round(jaro_winkler_similarity(l.name, r.name), 6) AS similarity "
    "FROM v l JOIN v r ON l.brand = r.brand AND l.city = r.city AND l.name < r.name "
    "WHERE jaro_winkler_similarity(l.name, r.name) >= 0.8",
    "fx_link",
)
def similar_values(spark, sf) -> DataFrame:
    near = find_similar(view(spark, sf, "fx_link"), ["brand", "city"], "name", 0.8)
    return near.withColumn("similarity", F.round("similarity", 6))


def _em_sql() -> str:
    """The estimation rounds written out, one pair of tables per round."""
    start = sco.starting_weights(PARTS)
    floor = sco.FLOOR

    def kept(x: str) -> str:
        return f"least(greatest({x}, {floor}), 1 - {floor})"

    def row(prior, m, u) -> str:
        return f"SELECT {prior} AS prior, " + ", ".join(
            f"{v} AS {t}_{c}_{at}"
            for t, table in (("m", m), ("u", u))
            for c, values in table.items()
            for at, v in enumerate(values)
        )

    def literal(values) -> dict:
        return {c: [f"{v!r}::DOUBLE" for v in vs] for c, vs in values.items()}

    sql = _PAIRS + (
        ", patterns AS (SELECT gamma_name, gamma_size, sum(n_pairs)::DOUBLE AS n FROM grouped "
        "GROUP BY ALL), w0 AS ("
        + row(f"{start.prior!r}::DOUBLE", literal(start.m), literal(start.u))
        + ")"
    )
    for i in range(PARTS.iterations):
        def product(t: str) -> str:
            return " * ".join(
                f"CASE gamma_{c.column} "
                + " ".join(f"WHEN {at} THEN {t}_{c.column}_{at}" for at in c.levels)
                + " END"
                for c in PARTS.comparisons
            )

        sql += (
            f", p{i} AS (SELECT gamma_name, gamma_size, n, prior * {product('m')} / "
            f"(prior * {product('m')} + (1 - prior) * {product('u')}) AS p "
            f"FROM patterns, w{i})"
        )
        estimate = {
            t: {
                c.column: [
                    kept(
                        f"coalesce(sum({share} * n) FILTER (gamma_{c.column} = {at}), 0) "
                        f"/ sum({share} * n)"
                    )
                    for at in c.levels
                ]
                for c in PARTS.comparisons
            }
            for t, share in (("m", "p"), ("u", "(1 - p)"))
        }
        sql += (
            f", w{i + 1} AS ("
            + row(kept("sum(p * n) / sum(n)"), estimate["m"], estimate["u"])
            + f" FROM p{i})"
        )
    last = f"w{PARTS.iterations}"
    lines = [
        f"SELECT '{c.column}' AS \"column\", {at} AS level, "
        f"(SELECT CAST(sum(n) AS BIGINT) FROM patterns WHERE gamma_{c.column} = {at}) AS n_pairs, "
        f"round(prior, 6) AS prior, round(m_{c.column}_{at}, 6) AS m, "
        f"round(u_{c.column}_{at}, 6) AS u FROM {last}"
        for c in PARTS.comparisons
        for at in c.levels
    ]
    return sql + " " + " UNION ALL ".join(lines)


@query(_em_sql(), "fx_link")
def estimate_em(spark, sf) -> DataFrame:
    groups = agr.agreement_groups(view(spark, sf, "fx_link"), PARTS)
    patterns = sco.cut_lineage(sco.pattern_counts(groups, PARTS))
    weights = sco.estimate_em(patterns, PARTS)
    return _integers(sco.weights_table(patterns, PARTS, weights))


@query(
    _PAIRS + f" SELECT *, {_probability(_odds(GIVEN))} AS match_probability FROM grouped",
    "fx_link",
)
def score(spark, sf) -> DataFrame:
    groups = agr.agreement_groups(view(spark, sf, "fx_link"), PARTS)
    return _integers(sco.score(groups, PARTS, GIVEN))


@query(
    "SELECT name, count(*) AS n, round(count(*) / (SELECT count(name) FROM fx_link)::DOUBLE, 6) "
    "AS tf FROM fx_link WHERE name IS NOT NULL GROUP BY name",
    "fx_link",
)
def term_frequencies(spark, sf) -> DataFrame:
    found = sco.term_frequencies(view(spark, sf, "fx_link"), "name")
    return found.withColumn("tf", F.round("tf", 6))


@query(
    _PAIRS
    + f" SELECT g.*, {_probability(_odds(GIVEN))} AS match_probability, "
    + f"{_probability(_odds(GIVEN, tf=True))} AS tf_match_probability FROM grouped g "
    + _tf("fx_link", "name") + " " + _tf("fx_link", "size"),
    "fx_link",
)
def scored_comparisons(spark, sf) -> DataFrame:
    return _integers(sco.scored_comparisons(view(spark, sf, "fx_link"), PARTS, GIVEN))


@query(
    ", pairs AS (SELECT l.name FROM fx_master l JOIN fx_master r ON l.name = r.name "
    "AND l.filing_num < r.filing_num), grouped AS (SELECT 1 AS gamma_name, name, "
    "count(*) AS n_pairs FROM pairs GROUP BY name) "
    f"SELECT g.*, {_probability(_odds(GIVEN_NAMES))} AS match_probability, "
    f"{_probability(_odds(GIVEN_NAMES, tf=True))} AS tf_match_probability FROM grouped g "
    + _tf("fx_master", "name"),
    "fx_master",
)
def dedupe_names(spark, sf) -> DataFrame:
    return _integers(dedupe.dedupe_names(view(spark, sf, "fx_master"), GIVEN_NAMES))


@query(
    _ADDRESS_PAIRS
    + f" SELECT g.*, {_probability(_odds(GIVEN_ADDRESSES))} AS match_probability, "
    + f"{_probability(_odds(GIVEN_ADDRESSES, tf=True))} AS tf_match_probability FROM grouped g "
    + " ".join(_tf("fx_address", c) for c in ("address1", "city", "zip_code")),
    "fx_address",
)
def dedupe_addresses(spark, sf) -> DataFrame:
    return _integers(dedupe.dedupe_addresses(view(spark, sf, "fx_address"), GIVEN_ADDRESSES))


def _sides_sql(*columns: str) -> str:
    return ", ".join(f"{side}.{c} AS {c}_{side}" for c in columns for side in "lr")


def _pair_tf(view_name: str, column: str) -> str:
    return (
        f"LEFT JOIN (SELECT {column} AS v, count(*) / (SELECT count({column}) FROM {view_name})::DOUBLE AS tf "
        f"FROM {view_name} GROUP BY {column}) tf_{column} ON tf_{column}.v = g.{column}_l"
    )


@query(
    f", pairs AS (SELECT {_sides_sql('unique_id', 'filing_num', 'brand', 'city', 'name', 'size')}, "
    "CASE WHEN l.name = r.name THEN 2 WHEN jaro_winkler_similarity(l.name, r.name) >= 0.9 THEN 1 ELSE 0 END AS gamma_name, "
    "CASE WHEN l.size = r.size THEN 1 ELSE 0 END AS gamma_size FROM fx_link l JOIN fx_link r "
    "ON l.brand = r.brand AND l.city = r.city AND l.unique_id < r.unique_id), "
    f"scored AS (SELECT g.*, {_probability(_odds(GIVEN))} AS match_probability, "
    f"{_probability(_odds(GIVEN, tf=True))} AS tf_match_probability FROM pairs g "
    + _pair_tf("fx_link", "name") + " " + _pair_tf("fx_link", "size")
    + ") SELECT * FROM scored WHERE match_probability >= 0.1",
    "fx_link",
)
def listed_pairs(spark, sf) -> DataFrame:
    """Record pairs of every group of parts scored 0.1 or more."""
    return dedupe.record_pairs(view(spark, sf, "fx_link"), PARTS, GIVEN, 0.1, digits=6)


_RECORD = "md5(concat_ws('|', 'Record', '=' || CAST(row_no AS VARCHAR), '=' || address1))"


@query(
    f", records AS (SELECT *, {_RECORD} AS unique_id FROM fx_address), pairs AS ("
    f"SELECT {_sides_sql('unique_id', 'filing_num', 'address1', 'city', 'zip_code')}, "
    + ", ".join(f"CASE WHEN l.{c} = r.{c} THEN 1 ELSE 0 END AS gamma_{c}" for c in ("address1", "city", "zip_code"))
    + " FROM records l JOIN records r ON l.unique_id < r.unique_id "
    "AND (l.address1 = r.address1 OR l.city = r.city OR l.zip_code = r.zip_code)), "
    f"scored AS (SELECT g.*, {_probability(_odds(GIVEN_ADDRESSES))} AS match_probability, "
    f"{_probability(_odds(GIVEN_ADDRESSES, tf=True))} AS tf_match_probability FROM pairs g "
    + " ".join(_pair_tf("fx_address", c) for c in ("address1", "city", "zip_code"))
    + ") SELECT * FROM scored WHERE match_probability >= 0.9",
    "fx_address",
)
def dedupe_addresses_pairs(spark, sf) -> DataFrame:
    """Pairs of address rows that are one place with a probability of 0.9 or more."""
    addresses = view(spark, sf, "fx_address")
    return dedupe.address_pairs(addresses, GIVEN_ADDRESSES, 0.9, ("row_no", "address1"), digits=6)


@query(
    f", pairs AS (SELECT md5(concat_ws('|', 'Record', '=' || CAST(l.filing_num AS VARCHAR), '=' || l.name)) AS a, "
    "md5(concat_ws('|', 'Record', '=' || CAST(r.filing_num AS VARCHAR), '=' || r.name)) AS b, l.filing_num AS fa, "
    "r.filing_num AS fb, l.name, 1 AS gamma_name FROM fx_master l JOIN fx_master r ON l.name = r.name AND l.filing_num < r.filing_num), "
    "g AS (SELECT least(a, b) AS unique_id_l, greatest(a, b) AS unique_id_r, CASE WHEN a < b THEN fa ELSE fb END AS filing_num_l, "
    "CASE WHEN a < b THEN fb ELSE fa END AS filing_num_r, name AS name_l, name AS name_r, gamma_name FROM pairs) "
    f"SELECT g.* EXCLUDE (gamma_name), {_probability(_odds(GIVEN_NAMES))} AS match_probability, "
    f"{_probability(_odds(GIVEN_NAMES, tf=True))} AS tf_match_probability FROM g " + _pair_tf("fx_master", "name"),
    "fx_master",
)
def dedupe_names_pairs(spark, sf) -> DataFrame:
    """Pairs of filings with one name."""
    return dedupe.name_pairs(view(spark, sf, "fx_master"), GIVEN_NAMES, 0.0, digits=6)


# Records and the keys they share: a pair per record and key instead of a pair
# per two records with the key.
_STARS = """, links AS (
  SELECT 'r' || row_no AS a, 'p' || address1 || city AS b FROM fx_address
  UNION SELECT 'r' || row_no, 'f' || filing_num || zip_code FROM fx_address),
ends AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(id, node) AS (
  SELECT DISTINCT a, a FROM ends UNION SELECT r.id, e.b FROM reach r JOIN ends e ON e.a = r.node)
"""


@query(
    _STARS + " /*recursive*/ SELECT id, min(node) AS cluster FROM reach GROUP BY id", "fx_address"
)
def components(spark, sf) -> DataFrame:
    record = F.concat(F.lit("r"), F.col("row_no").cast("string"))
    shared = F.array(
        F.concat(F.lit("p"), "address1", "city"),
        F.concat(F.lit("f"), F.col("filing_num").cast("string"), "zip_code"),
    )
    pairs = view(spark, sf, "fx_address").select(record.alias("id_l"), F.explode(shared).alias("id_r"))
    return cluster_pairs(pairs)


_GROUPED = r""", strings AS (SELECT pa AS s, count(*) AS copies, min(row_no) AS first_id
  FROM address_pa GROUP BY pa),
cleaned AS (SELECT s, copies, regexp_replace(upper(s), '[,\-./]|\s', '', 'g') AS t FROM strings),
grams AS (SELECT s, copies, substr(t, CAST(i AS INTEGER), 3) AS gram
  FROM cleaned, LATERAL (SELECT unnest(range(1, length(t) - 1)) AS i)),
tf AS (SELECT s, copies, gram, count(*) AS tf FROM grams GROUP BY ALL),
df AS (SELECT gram, sum(copies) AS df FROM tf GROUP BY gram),
raw AS (SELECT s, gram,
    tf * (ln(((SELECT sum(copies) FROM strings) + 1)::DOUBLE / (df + 1)) + 1) AS w
  FROM tf JOIN df USING (gram)),
norms AS (SELECT s, sqrt(sum(w * w)) AS norm FROM raw GROUP BY s),
vectors AS (SELECT s, gram, w / norm AS w FROM raw JOIN norms USING (s)),
alike AS (SELECT x.s AS a, y.s AS b FROM vectors x JOIN vectors y
    ON x.gram = y.gram AND x.s < y.s GROUP BY x.s, y.s HAVING sum(x.w * y.w) >= 0.8 - 1e-9),
ends AS (SELECT a, b FROM alike UNION SELECT b, a FROM alike),
reach(id, node) AS (
  SELECT s, s FROM strings UNION SELECT r.id, e.b FROM reach r JOIN ends e ON e.a = r.node),
named AS (SELECT id AS s, min(first_id) AS gp FROM reach JOIN strings ON s = node GROUP BY id)
/*recursive*/ """


@query(_GROUPED + "SELECT row_no, pa, gp FROM address_pa JOIN named ON s = pa", "address_pa")
def group_similar(spark, sf) -> DataFrame:
    addresses = with_canonical(view(spark, sf, "fx_address")).select("row_no", "pa")
    return group_strings(addresses, "pa", "row_no", 0.8)


@query(
    _GROUPED
    + "SELECT md5(concat_ws('|', 'Address', '=' || gp)) AS id, CAST(gp AS VARCHAR) AS gp, "
    "arg_max(address1, row_no) AS address1, arg_max(city, row_no) AS city, "
    "arg_max(zip_code, row_no) AS zip_code FROM matched JOIN named ON s = pa GROUP BY gp",
    "matched",
)
def grouped_address_nodes(spark, sf) -> DataFrame:
    """Address nodes keyed by similarity group instead of by exact address."""
    grouped = group_addresses(view(spark, sf, "fx_address"))
    business = business_nodes(name_index(view(spark, sf, "fx_master")))
    made = build_address_edges(grouped, business, ["row_no"], "gp")
    return made.nodes.select("id", "gp", "address1", "city", "zip_code")
