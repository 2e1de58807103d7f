"""Queries over the driver's tables, one for each operator, with DuckDB SQL that computes the same rows.

Amounts are summed as integer cents wherever a sum's order could show in the last digit.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from popforge.functions import scalars as S
from popforge.functions.rng import uniform
from popforge.operators import calibrate as K
from popforge.operators import entities, gates, geography, impute, lineage, normalize, spine
from popforge.operators import takeup as T
from popforge.plans import declared, execute, scoring
from popforge.plans.construct import CONTENT
from popforge.plans.construct import construct as construct_all
from popforge.plans.proxy import SEED, SOURCES, donors, households, persons, table
from popforge.sources import arrays, manifests, registry, target_store
from popforge.sources.storage import shared_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _u(key: str, seed: int | str = SEED) -> str:
    return f"(CAST('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE)"


_HH = "hh AS (SELECT c_custkey AS household_id, CAST(1 + c_custkey % 7 AS DOUBLE) AS weight, c_nationkey AS nation, c_mktsegment AS segment, c_acctbal AS balance FROM customer)"
_P = "p AS (SELECT o_orderkey AS person_id, o_custkey AS household_id, CAST(floor(o_totalprice / 5000) AS INTEGER) AS age, o_totalprice AS income, o_orderstatus AS status FROM orders)"
_D = "d AS (SELECT s_suppkey AS donor_id, s_nationkey AS nation, s_acctbal AS donor_balance, CAST(1 + s_suppkey % 5 AS BIGINT) AS donor_weight FROM supplier)"


# sources


@query("SELECT 'cps' AS alias, 'spine' AS role, count(*) AS n_rows FROM orders UNION ALL SELECT 'households', 'donor', count(*) FROM customer UNION ALL SELECT 'wealth', 'donor', count(*) FROM supplier UNION ALL SELECT 'lines', 'donor', count(*) FROM lineitem UNION ALL SELECT 'panel', 'donor', count(*) FROM events")
def src_registry_counts(spark, sf_dir):
    return registry.Registry.of(sf_dir, SOURCES).counts(spark)


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_quantity > 45")
def scan_pruned(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").where("l_quantity > 45").select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("SELECT event_id, user_id, value FROM events WHERE day(ts) = 12")
def filter_period(spark, sf_dir):
    return registry.for_period(table(spark, sf_dir, "events"), F.dayofmonth("ts"), 12).select("event_id", "user_id", "value")


@query(f"WITH {_HH}, {_P} SELECT person_id, p.household_id, age, income, status, nation AS state, weight FROM p LEFT JOIN hh USING (household_id)")
def load_household_rows(spark, sf_dir):
    return registry.household_rows(persons(spark, sf_dir), households(spark, sf_dir), "household_id", "household_id", {"state": "nation", "weight": "weight"})


def _exported(spark, sf_dir):
    """Households and persons exported as named arrays; the path."""
    path = f"{shared_dir(spark)}/export-{uuid.uuid4().hex}"
    arrays.export_population({"household": households(spark, sf_dir), "person": persons(spark, sf_dir)}, path)
    return path


@query(f"WITH {_HH}, {_P} SELECT person_id, p.household_id, age, income, status, nation AS state, weight FROM p LEFT JOIN hh USING (household_id)")
def named_arrays_household_rows(spark, sf_dir):
    """Persons and households exported as named arrays, committed at once, and read back in slices that are verified."""
    path = _exported(spark, sf_dir)
    people = arrays.read_arrays(spark, path, "person", verify=True)
    homes = arrays.read_arrays(spark, path, "household", columns=["household_id", "nation", "weight"], verify=True)
    return registry.household_rows(people, homes, "household_id", "household_id", {"state": "nation", "weight": "weight"})


@query("SELECT 'household' AS entity, count(*) AS n_rows, CAST(sum(c_custkey) AS BIGINT) AS key_sum FROM customer UNION ALL SELECT 'person', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders")
def export_population(spark, sf_dir):
    """Rows of each entity and the sum of its keys, as a reader of the export finds them."""
    path = _exported(spark, sf_dir)
    found = [arrays.read_arrays(spark, path, e, columns=[f"{e}_id"]).agg(F.lit(e).alias("entity"), F.count(F.lit(1)).alias("n_rows"), F.sum(f"{e}_id").alias("key_sum")) for e in ("household", "person")]
    return found[0].unionByName(found[1])


@query("SELECT row_number() OVER (ORDER BY s_suppkey) AS household_id, row_number() OVER (ORDER BY s_suppkey) AS person_id, s_suppkey AS donor_id, s_acctbal AS donor_balance FROM supplier")
def load_single_person(spark, sf_dir):
    return registry.single_person_households(donors(spark, sf_dir), ["donor_id"]).select("household_id", "person_id", "donor_id", "donor_balance")


@query("SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate) AS line_id, l_orderkey, l_linenumber, l_partkey FROM lineitem")
def generated_ids(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return registry.numbered(lines, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"], "line_id").select("line_id", "l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT s_suppkey AS donor_id, sha256(CAST(s_suppkey AS VARCHAR) || '|' || s_name || '|' || CAST(s_nationkey AS VARCHAR)) AS fingerprint FROM supplier")
def row_fingerprint(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("donor_id"), registry.row_fingerprint("s_suppkey", "s_name", "s_nationkey").alias("fingerprint"))


# projections


@query("SELECT c_custkey AS household_id, c_acctbal AS balance, c_mktsegment AS segment FROM customer")
def rename_direct(spark, sf_dir):
    block = normalize.Block(direct={"household_id": "c_custkey", "balance": "c_acctbal", "segment": "c_mktsegment"})
    return normalize.normalize(table(spark, sf_dir, "customer"), block)


@query("SELECT s_suppkey AS donor_id, s_nationkey AS weight, s_acctbal AS net_worth, s_acctbal AS bank_assets, s_name AS name FROM supplier")
def rename_fanout(spark, sf_dir):
    raw = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("donor_id"), F.col("s_nationkey").alias("weight"), "s_acctbal", "s_name")
    return registry.Observation("donor", "donor_id", "weight", (("s_acctbal", "net_worth"), ("s_acctbal", "bank_assets"), ("s_name", "name"))).apply(raw)


@query("SELECT c_custkey AS household_id, c_nationkey <> 0 AS is_abroad FROM customer")
def bool_cast(spark, sf_dir):
    return normalize.normalize(table(spark, sf_dir, "customer"), normalize.Block(direct={"household_id": "c_custkey"}, boolean={"is_abroad": "c_nationkey"}))


@query("SELECT o_orderkey AS person_id, o_orderstatus = 'F' AS is_male, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS sex FROM orders")
def bool_to_code(spark, sf_dir):
    block = normalize.Block(direct={"person_id": "o_orderkey"}, indicators={"is_male": ("o_orderstatus", "F")}, sex_code=("sex", "is_male", 1, 2))
    return normalize.normalize(table(spark, sf_dir, "orders"), block)


@query("SELECT o_orderkey AS person_id, o_orderpriority = '1-URGENT' AS is_urgent, o_orderstatus = 'O' AS is_open FROM orders")
def indicator_equals(spark, sf_dir):
    block = normalize.Block(direct={"person_id": "o_orderkey"}, indicators={"is_urgent": ("o_orderpriority", "1-URGENT"), "is_open": ("o_orderstatus", "O")})
    return normalize.normalize(table(spark, sf_dir, "orders"), block)


@query("SELECT o_orderkey AS person_id, CAST(floor(o_totalprice) AS INTEGER) AS dollars FROM orders")
def int_cast(spark, sf_dir):
    return normalize.normalize(table(spark, sf_dir, "orders"), normalize.Block(direct={"person_id": "o_orderkey", "dollars": "o_totalprice"}, integers=("dollars",)))


@query(f"WITH {_HH}, {_P} SELECT person_id, household_id, segment, balance FROM p LEFT JOIN hh USING (household_id)")
def row_indexed_lookup(spark, sf_dir):
    return registry.household_rows(persons(spark, sf_dir), households(spark, sf_dir), "household_id", "household_id", {"segment": "segment", "balance": "balance"}).select("person_id", "household_id", "segment", "balance")


@query(f"WITH {_HH}, {_P} SELECT person_id, CASE segment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 1 WHEN 'AUTOMOBILE' THEN 2 WHEN 'HOUSEHOLD' THEN 0 END AS tenure FROM p LEFT JOIN hh USING (household_id)")
def mapped_values(spark, sf_dir):
    rows = registry.household_rows(persons(spark, sf_dir), households(spark, sf_dir), "household_id", "household_id", {"segment": "segment"})
    block = normalize.Block(direct={"person_id": "person_id"}, mapped={"tenure": ("segment", {"BUILDING": 1, "MACHINERY": 1, "AUTOMOBILE": 2, "HOUSEHOLD": 0})})
    return normalize.normalize(rows, block)


@query("SELECT s_suppkey AS donor_id, s_acctbal AS net_worth, coalesce(CASE WHEN s_acctbal > 0 THEN s_acctbal END, -1.0::DOUBLE) AS positive_worth FROM supplier")
def fallback_coalesce(spark, sf_dir):
    block = normalize.Block(direct={"donor_id": "s_suppkey"}, fallback={"net_worth": ("networth", "s_acctbal", "s_nationkey")})
    found = normalize.normalize(table(spark, sf_dir, "supplier"), block)
    return found.withColumn("positive_worth", F.coalesce(F.when(F.col("net_worth") > 0, F.col("net_worth")), F.lit(-1.0)))


@query("SELECT p_partkey, CASE WHEN p_size > 25 THEN p_size ELSE 7 END AS size, p_size <= 25 AS is_default_size FROM part")
def default_fill(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") > 25, F.col("p_size")).alias("size"))
    return normalize.with_defaults(parts, {"size": 7})


@query("SELECT c_custkey AS household_id, c_acctbal AS balance, c_acctbal AS income, 0 AS state_fips, 0 AS tenure FROM customer")
def copy_constant(spark, sf_dir):
    block = normalize.Block(direct={"household_id": "c_custkey", "balance": "c_acctbal"}, constant={"state_fips": 0, "tenure": 0}, copy={"income": "balance"})
    return normalize.normalize(table(spark, sf_dir, "customer"), block)


@query("SELECT l_orderkey, l_linenumber, 0.0::DOUBLE + l_quantity + l_discount + l_tax AS income FROM lineitem")
def income_sum(spark, sf_dir):
    block = normalize.Block(direct={"l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber", "a": "l_quantity", "b": "l_discount", "c": "l_tax"}, sums={"income": ("a", "b", "c")})
    return normalize.normalize(table(spark, sf_dir, "lineitem"), block).select("l_orderkey", "l_linenumber", "income")


@query("SELECT l_orderkey, l_linenumber, 0.0::DOUBLE + l_extendedprice + l_discount + l_shipyear AS amounts FROM (SELECT *, CAST(year(l_shipdate) AS DOUBLE) AS l_shipyear FROM lineitem)")
def pattern_sum(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("AMT1"), F.col("l_discount").alias("AMT2"), F.year("l_shipdate").alias("AMT3"))
    return normalize.normalize(raw, normalize.Block(direct={"l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber"}, name_sums={"amounts": "AMT"}))


@query("SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS line_key, l_quantity FROM lineitem")
def composite_key(spark, sf_dir):
    return normalize.normalize(table(spark, sf_dir, "lineitem"), normalize.Block(direct={"l_quantity": "l_quantity"}, keys={"line_key": ("l_orderkey", "l_linenumber")}))


@query("SELECT event_id, value * 12.0::DOUBLE AS income FROM events WHERE day(ts) = 12")
def annualize(spark, sf_dir):
    raw = table(spark, sf_dir, "events").select("event_id", "value", F.dayofmonth("ts").alias("month"))
    return normalize.normalize(raw, normalize.Block(direct={"event_id": "event_id", "income": "value"}, annualized=("income",), period=("month", 12)))


@query(f"WITH {_P} SELECT household_id, min(person_id) AS head_id, arg_min(age, person_id) AS head_age, arg_min(status, person_id) AS head_status FROM p GROUP BY household_id")
def entity_split(spark, sf_dir):
    head, _ = normalize.split_entities(persons(spark, sf_dir), "household_id", ["person_id", "age", "status"], ["person_id"], ["person_id"])
    return head.select("household_id", F.col("person_id").alias("head_id"), F.col("age").alias("head_age"), F.col("status").alias("head_status"))


@query(f"WITH {_HH}, {_P} SELECT person_id, CAST(age AS DOUBLE) AS age, balance, weight, income FROM p LEFT JOIN hh USING (household_id)")
def feature_frame(spark, sf_dir):
    rows = registry.household_rows(persons(spark, sf_dir), households(spark, sf_dir), "household_id", "household_id", {"balance": "balance", "weight": "weight"})
    return rows.select("person_id", F.col("age").cast("double").alias("age"), "balance", "weight", "income")


@query("SELECT user_id, bool_or(event_type = 'click') AS has_click, bool_or(event_type = 'view') AS has_view, bool_or(event_type = 'purchase') AS has_purchase FROM events GROUP BY user_id")
def passthrough_flags(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(*[F.bool_or(F.col("event_type") == e).alias(f"has_{e}") for e in ("click", "view", "purchase")])


@query("SELECT user_id, a OR b OR c AS insured, NOT (a OR b OR c) AS uninsured, CAST(a AS INTEGER) + CAST(b AS INTEGER) + CAST(c AS INTEGER) > 1 AS multiple FROM (SELECT user_id, bool_or(event_type = 'click') AS a, bool_or(event_type = 'view') AS b, bool_or(event_type = 'purchase') AS c FROM events GROUP BY user_id)")
def coverage_recode(spark, sf_dir):
    kinds = {"private": ["has_click"], "public": ["has_view"], "military": ["has_purchase"]}
    return normalize.coverage_flags(passthrough_flags(spark, sf_dir), kinds, "insured", "uninsured", "multiple").select("user_id", "insured", "uninsured", "multiple")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN 0.0 ELSE least(greatest(l_quantity * 2 - 10, 0), 52) END AS weeks FROM lineitem")
def clip_zero_mask(spark, sf_dir):
    weeks = S.zero_where(S.clipped(F.col("l_quantity") * 2 - 10, 0.0, 52.0), F.col("l_returnflag") == "N")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", weeks.alias("weeks"))


# entities and spine


@query(f"WITH {_P} SELECT 'household' AS entity, household_id AS id FROM (SELECT DISTINCT household_id FROM p) UNION ALL SELECT 'person', person_id FROM (SELECT DISTINCT person_id FROM p)")
def entity_tables(spark, sf_dir):
    found = entities.entity_tables(persons(spark, sf_dir), {"household": "household_id", "person": "person_id"})
    return found["household"].select(F.lit("household").alias("entity"), F.col("household_id").alias("id")).unionByName(found["person"].select(F.lit("person").alias("entity"), F.col("person_id").alias("id")))


@query("SELECT 'order_line' AS link, (SELECT count(*) FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)) AS orphans UNION ALL SELECT 'order_customer', (SELECT count(*) FROM orders o WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey))")
def referential_integrity(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    one = entities.orphans(orders, "o_orderkey", table(spark, sf_dir, "lineitem"), "l_orderkey").agg(F.count(F.lit(1)).alias("orphans"))
    two = entities.orphans(orders, "o_custkey", table(spark, sf_dir, "customer"), "c_custkey").agg(F.count(F.lit(1)).alias("orphans"))
    return one.select(F.lit("order_line").alias("link"), "orphans").unionByName(two.select(F.lit("order_customer").alias("link"), "orphans"))


@query(f"WITH {_P} SELECT person_id, household_id, count(*) OVER w AS household_size, count(*) FILTER (age < 18) OVER w AS count_under_18, count(*) FILTER (age < 6) OVER w AS count_under_6 FROM p WINDOW w AS (PARTITION BY household_id)")
def household_counts(spark, sf_dir):
    found = entities.household_counts(persons(spark, sf_dir), "household_id", "age", {"count_under_18": 18, "count_under_6": 6})
    return found.select("person_id", "household_id", "household_size", "count_under_18", "count_under_6")


@query(f"WITH {_HH}, {_P} SELECT person_id, p.household_id, balance * (CASE WHEN sum(age) OVER w > 0 THEN age / nullif(CAST(sum(age) OVER w AS DOUBLE), 0) ELSE 1.0::DOUBLE / count(*) OVER w END) AS share FROM p JOIN hh USING (household_id) WINDOW w AS (PARTITION BY p.household_id)")
def allocate_to_members(spark, sf_dir):
    rows = persons(spark, sf_dir).join(households(spark, sf_dir).select("household_id", "balance"), "household_id")
    return entities.allocate(rows, "household_id", "balance", F.col("age").cast("double"), ["person_id"], "share").select("person_id", "household_id", "share")


@query("WITH g AS (SELECT s_nationkey AS nation, CAST(sum(CAST(round(s_acctbal * 100) AS BIGINT)) AS BIGINT) AS cents FROM supplier GROUP BY 1), m AS (SELECT c_custkey AS household_id, c_nationkey AS nation, cents, CASE WHEN c_nationkey % 5 > 0 THEN c_custkey % 7 ELSE 0 END AS w FROM customer LEFT JOIN g ON nation = c_nationkey), t AS (SELECT *, sum(w) OVER p AS total, count(*) OVER p AS n FROM m WINDOW p AS (PARTITION BY nation)), d AS (SELECT *, CASE WHEN total = 0 THEN n ELSE total END AS whole, abs(cents)::HUGEINT * CASE WHEN total = 0 THEN 1 ELSE w END AS part FROM t), r AS (SELECT *, part // whole AS down, part % whole AS rest FROM d), k AS (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY rest DESC, household_id) AS rank, abs(cents) - sum(down) OVER (PARTITION BY nation) AS left_over FROM r) SELECT household_id, nation, CAST(sign(cents) * (down + CASE WHEN rank <= left_over THEN 1 ELSE 0 END) AS BIGINT) AS cents FROM k")
def allocate_exactly(spark, sf_dir):
    """Each nation's cents dealt to its households in whole cents that add up; a fifth of the nations by heads."""
    cents = donors(spark, sf_dir).groupBy("nation").agg(F.sum(F.round(F.col("donor_balance") * 100).cast("long")).alias("whole"))
    members = households(spark, sf_dir).join(cents, "nation", "left").withColumn("w", F.when(F.col("nation") % 5 > 0, F.col("household_id") % 7).otherwise(F.lit(0)))
    return entities.allocate_exact(members, "nation", "whole", "w", "household_id", "cents").select("household_id", "nation", "cents")


@query("WITH RECURSIVE e AS (SELECT DISTINCT p_partkey AS node, p_partkey // k AS needs FROM part, (VALUES (2), (3)) v(k) WHERE p_partkey // k > 0), r AS (SELECT node, needs AS origin, 1 AS steps FROM e UNION SELECT r.node, e.needs, steps + 1 FROM r JOIN e ON e.node = r.origin) SELECT node, origin, CAST(min(steps) AS INTEGER) AS steps FROM r GROUP BY ALL")
def lineage_closure(spark, sf_dir):
    """All that each part is made from, where a part is made from those at a half and a third of its number."""
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("node"), F.explode(F.array(F.lit(2), F.lit(3))).alias("k"))
    return lineage.closure(parts.select("node", F.floor(F.col("node") / F.col("k")).alias("needs")).where("needs > 0"))


@query(f"WITH {_P} SELECT person_id, household_id, age FROM p")
def spine_strip(spark, sf_dir):
    return spine.strip(persons(spark, sf_dir), ["person_id", "household_id", "age"])


@query(f"WITH {_HH} SELECT household_id, nation, segment, balance, weight / 2 AS weight, 'keep' AS half, false AS is_clone FROM hh UNION ALL SELECT household_id + 10000000, nation, NULL, NULL, weight / 2, 'synthetic', true FROM hh")
def spine_union(spark, sf_dir):
    return spine.clone_spine(households(spark, sf_dir), ["household_id", "nation"], {"household_id": 10_000_000}, "weight")


@query(f"WITH {_P} SELECT person_id, household_id, 'keep' AS half FROM p UNION ALL SELECT person_id + 100000000, household_id + 10000000, 'synthetic' FROM p")
def spine_clone_ids(spark, sf_dir):
    return spine.clone_spine(persons(spark, sf_dir), ["age"], {"person_id": 100_000_000, "household_id": 10_000_000}).select("person_id", "household_id", "half")


@query(f"SELECT c_custkey AS household_id, CASE WHEN {_u('c_custkey')} < 0.5 THEN 'keep' ELSE 'synthetic' END AS half FROM customer")
def seeded_split(spark, sf_dir):
    return spine.split_spine(households(spark, sf_dir), "household_id", SEED).select("household_id", "half")


@query(f"WITH {_P}, cloned AS (SELECT income, status, 'keep' AS half FROM p UNION ALL SELECT NULL, NULL, 'synthetic' FROM p), split AS (SELECT income, CASE WHEN status = 'F' THEN status END AS status, {_u('person_id')} AS u FROM p) SELECT 'cloned' AS spine, 'income' AS variable, count(income) AS n FROM cloned WHERE half = 'synthetic' UNION ALL SELECT 'cloned', 'status', count(status) FROM cloned WHERE half = 'synthetic' UNION ALL SELECT 'split', 'income', count(income) FROM split WHERE u >= 0.5 UNION ALL SELECT 'split', 'status', count(status) FROM split WHERE u >= 0.5")
def collision_guard(spark, sf_dir):
    """A cloned spine passes; one that was split without stripping does not."""
    people = persons(spark, sf_dir)
    cloned = spine.clone_spine(people, ["age"], {"person_id": 100_000_000, "household_id": 10_000_000})
    split = spine.split_spine(people.withColumn("status", F.when(F.col("status") == "F", F.col("status"))), "person_id", SEED)
    found = [spine.collisions(df, ["income", "status"]).select(F.lit(name).alias("spine"), "variable", "n") for name, df in (("cloned", cloned), ("split", split))]
    return found[0].unionByName(found[1])


# imputation


def _nation_draws(spark, sf_dir):
    """household_id, segment_score, balance: the smallest donor of each nation stands for its donors."""
    cell = donors(spark, sf_dir).groupBy("nation").agg(F.min(F.struct("donor_id", "donor_balance")).alias("d"))
    return lambda recipients, variables: recipients.join(cell, "nation", "left").select("household_id", F.col("d.donor_balance").alias("balance"), F.col("d.donor_id").alias("wealth_rank"))


def _imputed(spark, sf_dir, steps):
    halves = spine.clone_spine(households(spark, sf_dir), ["nation"], {"household_id": 10_000_000}).withColumn("balance", F.when(F.col("balance") > 0, F.col("balance")))
    return impute.run_steps(halves, steps, _nation_draws(spark, sf_dir), "household_id").select("household_id", "half", "balance", "wealth_rank")


_SPINE = f"{_HH}, {_D}, halves AS (SELECT household_id, nation, CASE WHEN balance > 0 THEN balance END AS balance, 'keep' AS half FROM hh UNION ALL SELECT household_id + 10000000, nation, NULL, 'synthetic' FROM hh), cell AS (SELECT nation, arg_min(donor_balance, donor_id) AS b, min(donor_id) AS r FROM d GROUP BY nation), j AS (SELECT * FROM halves LEFT JOIN cell USING (nation))"


@query(f"WITH {_SPINE} SELECT household_id, half, CASE WHEN half = 'synthetic' THEN b ELSE balance END AS balance, CASE WHEN half = 'synthetic' THEN r END AS wealth_rank FROM j")
def impute_synth_half(spark, sf_dir):
    return _imputed(spark, sf_dir, [impute.Step("synthetic", ("balance", "wealth_rank"), True)])


@query(f"WITH {_SPINE} SELECT household_id, half, CASE WHEN half = 'keep' THEN coalesce(balance, b) ELSE balance END AS balance, CASE WHEN half = 'keep' THEN r END AS wealth_rank FROM j")
def impute_fill_missing(spark, sf_dir):
    return _imputed(spark, sf_dir, [impute.Step("keep", ("balance", "wealth_rank"), False)])


@query(f"WITH {_SPINE} SELECT household_id, half, CASE WHEN half = 'keep' THEN b ELSE balance END AS balance, CASE WHEN half = 'keep' THEN r END AS wealth_rank FROM j")
def impute_override(spark, sf_dir):
    return _imputed(spark, sf_dir, [impute.Step("keep", ("balance", "wealth_rank"), False), impute.Step("keep", ("balance",), True)])


@query(f"WITH {_HH}, {_D} SELECT household_id, donor_id FROM (SELECT household_id, donor_id, row_number() OVER (PARTITION BY household_id ORDER BY abs(balance - donor_balance), donor_id) AS r FROM hh LEFT JOIN d USING (nation)) WHERE r = 1")
def impute_donor_match(spark, sf_dir):
    return impute.nearest_donor(households(spark, sf_dir), donors(spark, sf_dir), "household_id", "donor_id", "nation", "balance", "donor_balance")


@query(f"WITH {_HH}, {_D}, a AS (SELECT household_id, CASE WHEN household_id % 50 > 1 THEN nation % 2 END AS cell, CASE WHEN household_id % 13 > 0 THEN CASE WHEN household_id % 5 > 0 THEN 0 ELSE balance END END AS wealth FROM hh), b AS (SELECT donor_id, CASE WHEN donor_id % 9 > 0 THEN nation % 2 END AS cell, CASE WHEN donor_id % 4 > 0 THEN CASE WHEN donor_id % 5 > 0 THEN 0 ELSE donor_balance END END AS net_worth FROM d) SELECT household_id, donor_id FROM (SELECT household_id, donor_id, row_number() OVER (PARTITION BY household_id ORDER BY abs(wealth - net_worth) NULLS LAST, donor_id) AS r FROM a LEFT JOIN b USING (cell)) WHERE r = 1")
def impute_donor_match_sparse(spark, sf_dir):
    """Values that are mostly zero, as survey amounts are, or missing; two cells, some of them unknown."""
    sparse = lambda key, value, gaps: F.when(F.col(key) % gaps > 0, F.when(F.col(key) % 5 > 0, F.lit(0)).otherwise(F.col(value)))
    asked = households(spark, sf_dir).select("household_id", F.when(F.col("household_id") % 50 > 1, F.col("nation") % 2).alias("cell"), sparse("household_id", "balance", 13).alias("wealth"))
    given = donors(spark, sf_dir).select("donor_id", F.when(F.col("donor_id") % 9 > 0, F.col("nation") % 2).alias("cell"), sparse("donor_id", "donor_balance", 4).alias("net_worth"))
    return impute.nearest_donor(asked, given, "household_id", "donor_id", "cell", "wealth", "net_worth")


@query(f"WITH {_HH}, c AS (SELECT nation, household_id, balance, sum(weight) OVER (PARTITION BY nation ORDER BY balance, household_id) AS cw, sum(weight) OVER (PARTITION BY nation) AS tw FROM hh) SELECT nation, arg_min(balance, cw) AS median_balance FROM c WHERE cw >= 0.5 * tw GROUP BY nation")
def weighted_quantile(spark, sf_dir):
    return impute.weighted_quantile(households(spark, sf_dir), "nation", "balance", "weight", 0.5, "household_id", "median_balance")


def _components(spark, sf_dir):
    cents = F.floor(F.col("l_extendedprice") * 100).cast("long")
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(*[F.sum(F.when(F.col("l_returnflag") == f, cents).otherwise(F.lit(0).cast("long"))).alias(name) for f, name in (("A", "assets"), ("N", "housing"), ("R", "debt"))])


_COMP = "c AS (SELECT l_orderkey, CAST(sum(CASE WHEN l_returnflag = 'A' THEN CAST(floor(l_extendedprice * 100) AS BIGINT) ELSE 0 END) AS BIGINT) AS assets, CAST(sum(CASE WHEN l_returnflag = 'N' THEN CAST(floor(l_extendedprice * 100) AS BIGINT) ELSE 0 END) AS BIGINT) AS housing, CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(floor(l_extendedprice * 100) AS BIGINT) ELSE 0 END) AS BIGINT) AS debt FROM lineitem GROUP BY l_orderkey)"
_SIGNS = {"assets": 1, "housing": 1, "debt": -1}


@query(f"WITH {_COMP} SELECT l_orderkey, assets, housing, debt, assets + housing - debt AS net_worth FROM c")
def net_worth_components(spark, sf_dir):
    found = _components(spark, sf_dir)
    return found.withColumn("net_worth", impute.signed_components(found, _SIGNS))


@query(f"WITH {_COMP} SELECT l_orderkey, assets * f AS assets, housing * f AS housing, debt * f AS debt FROM (SELECT *, CASE WHEN assets + housing - debt <> 0 THEN 1000000::BIGINT / CAST(nullif(assets + housing - debt, 0) AS DOUBLE) ELSE 1.0::DOUBLE END AS f FROM c)")
def net_worth_rebalance(spark, sf_dir):
    found = _components(spark, sf_dir)
    scaled = impute.rebalance(list(_SIGNS), impute.signed_components(found, _SIGNS), F.lit(1_000_000))
    return found.select("l_orderkey", *[c.alias(name) for name, c in scaled.items()])


@query()
def forest_quantile(spark, sf_dir):
    """household_id, lower, median, upper of the donors' balance given nation and size; within 1/64 of their ranks, so without SQL."""
    given = donors(spark, sf_dir).withColumn("size", F.col("donor_id") % 3)
    asked = households(spark, sf_dir).select("household_id", "nation", (F.col("household_id") % 3).alias("size"))
    return impute.forest_quantiles(impute.Donors(given, "donor_id", "donor_weight"), asked, "household_id", "donor_balance", ["nation", "size"], {"lower": 0.25, "median": 0.5, "upper": 0.75}, trees=10, depth=5, least=2)


@query()
def qrf_sample(spark, sf_dir):
    """household_id, donor_id drawn from forest leaves; no SQL form."""
    given = donors(spark, sf_dir).select("donor_id", F.col("nation").cast("double").alias("nation_code"), (F.col("donor_id") % 3).cast("double").alias("size"), "donor_balance", "donor_weight")
    sampler = impute.ForestSampler(["nation_code", "size"], "donor_balance", "donor_id", "donor_weight", trees=10, depth=5, least=2).fit(given)
    asked = households(spark, sf_dir).select("household_id", F.col("nation").cast("double").alias("nation_code"), (F.col("household_id") % 3).cast("double").alias("size"))
    return sampler.draw(asked, "household_id")


def _demographics(spark, sf_dir):
    """Halves of households and their tax donors, with nation and size as demographics."""
    homes = households(spark, sf_dir).select("household_id", "nation", (F.col("household_id") % 3).alias("size"), F.when(F.col("balance") > 0, F.col("balance")).alias("balance"))
    given = donors(spark, sf_dir).select("donor_id", "nation", (F.col("donor_id") % 3).alias("size"), F.col("donor_balance").alias("balance"), (F.col("donor_balance") < 0).alias("would_be_qualified"), "donor_weight")
    return spine.clone_spine(homes, ["nation", "size"], {"household_id": 10_000_000}), impute.Donors(given, "donor_id", "donor_weight")


@query()
def impute_forest_steps(spark, sf_dir):
    """household_id, half, balance, would_be_qualified: three steps drawn by chained forests; no SQL form."""
    halves, given = _demographics(spark, sf_dir)
    variables = ("balance", "would_be_qualified")
    steps = [impute.Step("synthetic", variables, True, ("demographics",)), impute.Step("keep", variables, False, ("demographics",)), impute.Step("keep", ("would_be_qualified",), True, ("demographics",))]
    found = impute.forest_steps(halves, steps, given, "household_id", {"demographics": ["nation", "size"]}, trees=10, depth=5, least=2)
    return found.select("household_id", "half", "balance", "would_be_qualified")


@query()
def weeks_unemployed(spark, sf_dir):
    """household_id, compensation, weeks: drawn conditional on compensation, clipped and masked; no SQL form."""
    given = donors(spark, sf_dir).select("donor_id", F.when(F.col("donor_id") % 2 == 0, F.abs("donor_balance")).otherwise(F.lit(0.0)).alias("compensation"), (F.col("donor_balance") / 100).alias("weeks"), "donor_weight")
    asked = households(spark, sf_dir).select("household_id", F.greatest(F.col("balance"), F.lit(0.0)).alias("compensation"))
    drawn = impute.draw_weeks_unemployed(impute.Donors(given, "donor_id", "donor_weight"), asked, "household_id", "weeks", "compensation", trees=10, depth=5, least=2)
    return asked.join(drawn, "household_id")


def _blocks():
    return manifests.load_blocks((CONTENT / "blocks.json").read_text())


@query(f"WITH {_HH}, {_P}, t AS (SELECT *, CASE segment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 1 WHEN 'AUTOMOBILE' THEN 2 WHEN 'HOUSEHOLD' THEN 0 END AS tenure FROM p LEFT JOIN hh USING (household_id)) SELECT person_id, household_id, weight, CAST(age AS DOUBLE) AS age, CAST(tenure AS DOUBLE) AS tenure, CAST(count(*) FILTER (age < 18) OVER w AS DOUBLE) AS count_under_18, CAST(count(*) OVER w AS DOUBLE) AS household_size, income + 0.0::DOUBLE AS income FROM t WINDOW w AS (PARTITION BY household_id)")
def source_block_frame(spark, sf_dir):
    """Predictors and targets of a block read by its manifest."""
    block = _blocks()["homes"]
    return block.model_frame(block.build(persons(spark, sf_dir), households(spark, sf_dir)))


@query(f"WITH {_D} SELECT row_number() OVER (ORDER BY donor_id) AS household_id, nation, 0 AS tenure, donor_weight AS weight, donor_balance AS net_worth, donor_balance AS assets FROM d")
def source_block_entities(spark, sf_dir):
    """Households and persons of a block of single persons, joined again."""
    block = _blocks()["wealth"]
    homes, people = block.entities(block.build(donors(spark, sf_dir), order=["donor_id"]))
    return homes.join(people, "household_id").drop("person_id")


@query()
def source_block_impute(spark, sf_dir):
    """household_id, net_worth: drawn directly by a forest from a block's survey; no SQL form."""
    block = _blocks()["wealth"]
    given = block.model_frame(block.build(donors(spark, sf_dir), order=["donor_id"]))
    asked = households(spark, sf_dir).select("household_id", *block.predictors)
    return impute.forest_draws(impute.Donors(given, "person_id", "weight"), asked, "household_id", block.targets, block.predictors, trees=10, depth=5, least=2)


_PANEL_SCHEMA = "SSUID long, MONTHCODE int, PNUM long, TAGE double, ESEX int, TXAMT1 double, TXAMT2 double, TOTAL double, VAL_BANK double, VAL_STOCK double, VAL_BOND double, CARS int, VAL_CARS double, W double"


def _panel(spark, sf_dir):
    """Line items written as a delimited survey of person-months; the folder. Half of the tips are missing."""
    at = lambda name: F.col(f"l_{name}")
    rows = table(spark, sf_dir, "lineitem").select(
        at("orderkey").alias("SSUID"), F.month("l_shipdate").alias("MONTHCODE"), at("linenumber").alias("PNUM"), at("quantity").alias("TAGE"), (1 + at("linenumber") % 2).alias("ESEX"),
        F.when(at("linenumber") % 2 == 0, F.round(at("tax") * 100)).alias("TXAMT1"), F.round(at("discount") * 100).alias("TXAMT2"), F.floor("l_extendedprice").alias("TOTAL"),
        F.floor(at("extendedprice") / 7).alias("VAL_BANK"), F.when(at("quantity") > 25, F.floor(at("extendedprice") / 3)).otherwise(F.lit(0)).alias("VAL_STOCK"), F.when(at("quantity") > 40, F.lit(500)).otherwise(F.lit(0)).alias("VAL_BOND"),
        (at("linenumber") % 3).alias("CARS"), (at("linenumber") % 3 * 4000).alias("VAL_CARS"), (1 + at("linenumber") % 3).alias("W"),
    )
    folder = f"{shared_dir(spark)}/panel-{uuid.uuid4().hex}"
    rows.write.csv(f"{folder}/panel.csv", sep="|", header=True, compression="gzip")
    return folder


@query("WITH r AS (SELECT l_orderkey || '-' || month(l_shipdate) AS household_id, l_orderkey || '-' || month(l_shipdate) || '-' || l_linenumber AS person_id, CAST(floor(l_quantity) AS INTEGER) AS age, floor(l_extendedprice) * 12.0 AS wages, floor(l_extendedprice) AS income, 12.0 * (CASE WHEN l_linenumber % 2 = 0 THEN round(l_tax * 100) ELSE 0 END + round(l_discount * 100)) AS tip_income, CAST(1 + l_linenumber % 3 AS DOUBLE) AS weight FROM lineitem) SELECT *, count(*) FILTER (age < 18) OVER (PARTITION BY household_id) AS count_under_18 FROM r")
def delimited_block(spark, sf_dir):
    """Person-months of a delimited survey, read and normalised by their manifest."""
    block = _blocks()["tips"]
    rows = block.build(block.read(spark, _panel(spark, sf_dir), _PANEL_SCHEMA))
    return rows.select("household_id", "person_id", "age", "wages", "income", "tip_income", "weight", "count_under_18")


@query()
def blocks_impute(spark, sf_dir):
    """household_id and the eight targets of four blocks, two of them delimited, drawn by forests; no SQL form."""
    blocks, folder = _blocks(), _panel(spark, sf_dir)
    homes = households(spark, sf_dir)
    asked = homes.select("household_id", "nation", (F.abs("balance") * 12).alias("wages"), (F.col("household_id") % 50).cast("double").alias("age"), (F.col("household_id") % 2 == 0).alias("is_female"), (F.col("household_id") % 3).alias("count_under_18"), (F.col("household_id") % 3).alias("tenure"), (F.col("household_id") % 5).alias("household_size"))
    raw = {"homes": (persons(spark, sf_dir), homes), "wealth": (donors(spark, sf_dir),)} | {name: (blocks[name].read(spark, folder, _PANEL_SCHEMA),) for name in ("tips", "holdings")}
    out = homes.select("household_id")
    for name, frames in raw.items():
        rows = blocks[name].build(*frames, order=["donor_id"] if blocks[name].generated_ids else ())
        out = out.join(blocks[name].draw(rows, asked, "household_id", trees=5, depth=4, least=2), "household_id")
    return out


@query()
def construct(spark, sf_dir):
    """The whole plan, from specification to gated export; no SQL form."""
    return construct_all(spark, sf_dir)


# geography and take-up


@query(f"WITH {_HH}, s AS (SELECT s_nationkey AS nation, s_suppkey AS block, CAST(1 + s_suppkey % 5 AS BIGINT) AS n FROM supplier), i AS (SELECT nation, block, (sum(n) OVER (PARTITION BY nation ORDER BY block) - n) / CAST(sum(n) OVER (PARTITION BY nation) AS DOUBLE) AS low, CASE WHEN row_number() OVER (PARTITION BY nation ORDER BY block DESC) = 1 THEN 2.0::DOUBLE ELSE sum(n) OVER (PARTITION BY nation ORDER BY block) / CAST(sum(n) OVER (PARTITION BY nation) AS DOUBLE) END AS high FROM s), x AS (SELECT household_id, nation, {_u('household_id')} AS u FROM hh) SELECT household_id, x.nation, block FROM x LEFT JOIN i ON x.nation = i.nation AND u >= low AND u < high")
def geo_assign(spark, sf_dir):
    units = donors(spark, sf_dir).select("nation", F.col("donor_id").alias("block"), "donor_weight")
    shares = geography.intervals(units, "nation", "block", "donor_weight")
    return geography.assign(households(spark, sf_dir).select("household_id", "nation"), "household_id", "nation", shares, "block", SEED)


_STATE = "CAST(30 + {} % 10 AS VARCHAR)"
_SUFFIX = "lpad(CAST([5, 47, 61, 81, 85, 1, 3, 7][CAST({} % 8 AS INTEGER) + 1] AS VARCHAR), 3, '0')"
_BLOCKS = f"blocks AS (SELECT {_STATE.format('s_nationkey')} || {_SUFFIX.format('s_suppkey')} || lpad(CAST(s_suppkey % 1000000 AS VARCHAR), 6, '0') || lpad(CAST(s_suppkey // 1000000 AS VARCHAR), 4, '0') AS block, CAST(1 + s_suppkey % 5 AS BIGINT) AS n, {_STATE.format('s_nationkey')} || lpad(CAST(s_suppkey % 7 AS VARCHAR), 2, '0') AS district FROM supplier)"
_HOMES = f"homes AS (SELECT c_custkey + k * 10000000 AS household_id, (1 + c_custkey % 7) / 2.0::DOUBLE AS household_weight, CASE WHEN c_custkey % 30 = 0 THEN '99999' WHEN c_custkey % 3 = 0 THEN {_STATE.format('c_nationkey')} || {_SUFFIX.format('c_custkey')} END AS known_county, CASE WHEN c_custkey % 3 <> 2 THEN {_STATE.format('c_nationkey')} END AS known_state FROM customer, (VALUES (0), (1)) v(k))"
_LOWEST = f"{_BLOCKS}, {_HOMES}, areas AS (SELECT l.level, CASE l.level WHEN 'county' THEN substr(block, 1, 5) WHEN 'state' THEN substr(block, 1, 2) ELSE '' END AS area, block, n, district FROM blocks, (VALUES ('county'), ('state'), ('all')) l(level)), i AS (SELECT level, area, block, district, (sum(n) OVER w - n) / CAST(sum(n) OVER (PARTITION BY level, area) AS DOUBLE) AS low, CASE WHEN row_number() OVER (PARTITION BY level, area ORDER BY block DESC) = 1 THEN 2.0::DOUBLE ELSE sum(n) OVER w / CAST(sum(n) OVER (PARTITION BY level, area) AS DOUBLE) END AS high FROM areas WINDOW w AS (PARTITION BY level, area ORDER BY block)), placed AS (SELECT household_id, household_weight, CASE WHEN known_county IN (SELECT area FROM areas WHERE level = 'county') THEN 'county' WHEN known_state IN (SELECT area FROM areas WHERE level = 'state') THEN 'state' ELSE 'all' END AS level, CASE WHEN known_county IN (SELECT area FROM areas WHERE level = 'county') THEN known_county WHEN known_state IN (SELECT area FROM areas WHERE level = 'state') THEN known_state ELSE '' END AS area, {_u('household_id')} AS u FROM homes), found AS (SELECT household_id, household_weight, placed.level AS known_at, block, district FROM placed LEFT JOIN i ON placed.level = i.level AND placed.area = i.area AND u >= low AND u < high)"


@query(f"WITH {_LOWEST} SELECT household_id, block AS block_geoid, substr(block, 1, 11) AS tract_geoid, substr(block, 1, 5) AS county_fips, substr(block, 1, 2) AS state_fips, district AS congressional_district_geoid, known_at AS block_known_at FROM found")
def geo_assign_lowest(spark, sf_dir):
    """Blocks drawn in the county where it is known and exists, else in the state, else anywhere."""
    homes = declared.halves(spark, sf_dir)["household"].select("household_id", "known_county", "known_state")
    found = declared.census(spark, sf_dir).checked().attach(homes, "household_id", {"county": "known_county", "state": "known_state"}, SEED)
    return found.drop("known_county", "known_state")


@query(f"WITH {_BLOCKS} SELECT 'block' AS \"column\", count(*) FILTER (length(block) <> 15) AS n_bad FROM blocks UNION ALL SELECT 'congressional_district', count(*) FILTER (length(district) <> 4) FROM blocks")
def geo_crosswalk_gate(spark, sf_dir):
    return declared.census(spark, sf_dir).violations()


def _declared(spark, sf_dir, *entities):
    """Entities of the declared specification, without what is drawn by forests."""
    spec, given = declared.load(), declared.inputs(spark, sf_dir)
    wanted = [v.name for v in spec.variables.values() if v.entity in entities and v.kind != "impute"]
    made = execute.execute(spec, given, execute.plan(spec, given, wanted))
    return [made[entity] for entity in entities]


@query(f"WITH {_LOWEST} SELECT household_id, household_weight, block AS block_geoid, substr(block, 1, 11) AS tract_geoid, substr(block, 1, 5) AS county_fips, substr(block, 1, 2) AS state_fips, district AS congressional_district_geoid, coalesce(substr(block, 1, 5) IN ('36005', '36047', '36061', '36081', '36085'), false) AS in_nyc FROM found")
def declared_households(spark, sf_dir):
    """Households as a specification of the full layout declares them: halves, geography by source, derived places."""
    return _declared(spark, sf_dir, "household")[0]


_PEOPLE = "people AS (SELECT o_orderkey + k * 1000000000 AS person_id, o_custkey + k * 10000000 AS person_household_id, CAST(floor(o_totalprice / 5000) AS INTEGER) AS age, CASE WHEN k = 0 THEN o_orderstatus = 'F' END AS reported_insured FROM orders, (VALUES (0), (1)) v(k))"


@query(f"WITH {_PEOPLE} SELECT person_id, person_household_id, person_household_id * 10 + person_id % 3 AS person_tax_unit_id, person_household_id * 10 AS person_spm_unit_id, person_household_id * 10 + person_id % 2 AS person_family_id, person_household_id * 10 + person_id % 4 AS person_marital_unit_id, age, reported_insured, {_u('person_id', f'{SEED}:takes_up_coverage')} < 0.6 AS takes_up_coverage FROM people")
def declared_persons(spark, sf_dir):
    return _declared(spark, sf_dir, "person")[0]


@query(f"WITH {_PEOPLE}, t AS (SELECT DISTINCT person_household_id * 10 + person_id % 3 AS id FROM people), s AS (SELECT DISTINCT person_household_id * 10 AS id FROM people) SELECT 'tax_unit' AS entity, id AS unit_id, {_u('id', f'{SEED}:files_voluntarily')} < 0.25 AS takes_part FROM t UNION ALL SELECT 'spm_unit', id, {_u('id', f'{SEED}:takes_up_meals')} < 0.8 FROM s")
def declared_units(spark, sf_dir):
    """Two of the other entities, with the programs that are drawn for them."""
    tax, spm = _declared(spark, sf_dir, "tax_unit", "spm_unit")
    one = lambda df, entity, taken: df.select(F.lit(entity).alias("entity"), F.col(f"{entity}_id").alias("unit_id"), F.col(taken).alias("takes_part"))
    return one(tax, "tax_unit", "files_voluntarily").unionByName(one(spm, "spm_unit", "takes_up_meals"))


@query()
def construct_declared(spark, sf_dir):
    """The calibrated households of the declared specification, all draws included, as a reader of the export of all six
    entities finds them; no SQL form."""
    path = f"{shared_dir(spark)}/export-{uuid.uuid4().hex}"
    arrays.export_population(declared.construct(spark, sf_dir), path)
    return arrays.read_arrays(spark, path, "household", verify=True)


_GEO = "g AS (SELECT s_suppkey AS id, lpad(CAST(s_suppkey * 7919 AS VARCHAR), 15, '0') AS block_geoid, lpad(CAST(s_nationkey AS VARCHAR), 4, '0') AS congressional_district_geoid FROM supplier)"


def _codes(spark, sf_dir):
    codes = geography.encode(F.col("s_suppkey") * 7919, "s_nationkey")
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), *[c.alias(name) for name, c in codes.items()])


@query("WITH x AS (SELECT lpad(CAST(s_suppkey * 7919 AS VARCHAR), 15, '0') AS block, lpad(CAST(s_nationkey AS VARCHAR), 4, '0') AS district FROM supplier) SELECT c_custkey AS household_id, district AS congressional_district_geoid FROM customer LEFT JOIN x ON block = lpad(CAST((c_custkey % 80) * 7919 AS VARCHAR), 15, '0')")
def geo_district(spark, sf_dir):
    crosswalk = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 7919).alias("block_geoid"), F.col("s_nationkey").alias("district"))
    homes = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("household_id"), ((F.col("c_custkey") % 80) * 7919).alias("block"))
    return geography.with_district(homes, "block", crosswalk).drop("block")


@query(f"WITH {_GEO} SELECT id, block_geoid, substr(block_geoid, 1, 11) AS tract_geoid, substr(block_geoid, 1, 5) AS county_fips, substr(block_geoid, 1, 2) AS state_fips, congressional_district_geoid FROM g")
def geoid_encode(spark, sf_dir):
    return _codes(spark, sf_dir)


@query(f"WITH {_GEO} SELECT 'block_geoid' AS \"column\", count(*) FILTER (length(block_geoid) <> 15) AS n_bad FROM g UNION ALL SELECT 'congressional_district_geoid', count(*) FILTER (length(congressional_district_geoid) <> 3) FROM g")
def geoid_width_gate(spark, sf_dir):
    return geography.width_violations(_codes(spark, sf_dir), {"block_geoid": 15, "congressional_district_geoid": 3})


@query("SELECT c_custkey AS household_id, lpad(CAST(c_nationkey AS VARCHAR), 5, '0') IN ('00003', '00005', '00011') AS in_area FROM customer")
def derive_in_set(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("household_id"), geography.in_set(S.fixed_width("c_nationkey", 5), ("00003", "00005", "00011")).alias("in_area"))


@query(f"SELECT c_custkey AS household_id, {_u('c_custkey', f'{SEED}:snap')} < 0.82 AS snap, {_u('c_custkey', f'{SEED}:ssi')} < 0.6 AS ssi FROM customer")
def takeup_bernoulli(spark, sf_dir):
    return T.rerandomize(households(spark, sf_dir).select("household_id"), "household_id", {"snap": 0.82, "ssi": 0.6}, SEED)


@query(f"WITH {_HH}, {_P} SELECT person_id, {_u('person_id', f'{SEED}:aca')} < CASE segment WHEN 'BUILDING' THEN 0.7 WHEN 'MACHINERY' THEN 0.4 ELSE 0.1 END AS aca FROM p LEFT JOIN hh USING (household_id)")
def takeup_by_group(spark, sf_dir):
    rows = registry.household_rows(persons(spark, sf_dir), households(spark, sf_dir), "household_id", "household_id", {"segment": "segment"})
    return rows.select("person_id", T.takeup("person_id", "aca", T.group_rate("segment", {"BUILDING": 0.7, "MACHINERY": 0.4}, 0.1), SEED).alias("aca"))


# targets and calibration


def _cells(spark, sf_dir):
    """Households with region and balance bracket."""
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation"), F.col("n_regionkey").alias("region"))
    return households(spark, sf_dir).join(nations, "nation").withColumn("bracket", F.floor(F.col("balance") / 2500).cast("int"))


def _matrix(spark, sf_dir):
    return K.loss_matrix(_cells(spark, sf_dir), "household_id", {"region": (F.col("region"), F.lit(1.0)), "bracket": (F.col("bracket"), F.floor(F.col("balance")).cast("double"))})


def _weights(spark, sf_dir):
    return households(spark, sf_dir).select(F.col("household_id").alias("unit"), F.col("weight").alias("w"))


def _targets(spark, sf_dir):
    """target_id, bucket, value: estimates with all weights at 4, in buckets by kind."""
    flat = _weights(spark, sf_dir).withColumn("w", F.lit(4.0))
    return K.estimates(_matrix(spark, sf_dir), flat).select("target_id", F.substring_index("target_id", "/", 1).alias("bucket"), F.col("estimate").alias("value"))


_CELLS = f"{_HH}, cells AS (SELECT household_id, weight, n_regionkey AS region, CAST(floor(balance / 2500) AS INTEGER) AS bracket, floor(balance) AS coef FROM hh JOIN nation ON n_nationkey = nation), m AS (SELECT 'region/' || CAST(region AS VARCHAR) AS target_id, household_id AS unit, 1.0::DOUBLE AS coef, weight AS w FROM cells UNION ALL SELECT 'bracket/' || CAST(bracket AS VARCHAR), household_id, coef, weight FROM cells WHERE coef <> 0)"
_SCORED = f"{_CELLS}, e AS (SELECT target_id, sum(coef * w) AS estimate, sum(coef * 4.0) AS value FROM m GROUP BY target_id), s AS (SELECT target_id, split_part(target_id, '/', 1) AS bucket, value, (estimate - value) / nullif(abs(value), 0) AS residual FROM e)"


def _scored(spark, sf_dir):
    return K._scored(_matrix(spark, sf_dir), _weights(spark, sf_dir), _targets(spark, sf_dir))


@query(f"WITH {_SCORED} SELECT target_id, value FROM s WHERE bucket = 'region'")
def target_select(spark, sf_dir):
    level = F.when(F.col("bucket") == "region", "state").otherwise(F.lit("national"))
    given = _targets(spark, sf_dir).select("target_id", "value", level.alias("geo_level"), F.lit(None).cast("string").alias("state_fips"), F.lit("zz").alias("country"), F.lit(2024).alias("model_year"), F.explode(F.array(F.lit("proxy"), F.lit("other"))).alias("profile"))
    return K.select_targets(given, "zz", 2024, "proxy", "state").select("target_id", "value")


_PARTS = "SELECT target_id, CASE WHEN bucket = 'region' THEN 'state' ELSE 'national' END AS geo_level, residual, CASE WHEN abs(residual) <= 1 THEN 0.5 * residual * residual ELSE abs(residual) - 0.5 END / count(*) OVER (PARTITION BY bucket) AS part FROM {} WHERE residual IS NOT NULL"


@query(f"WITH {_SCORED}, late AS (SELECT target_id, split_part(target_id, '/', 1) AS bucket, (sum(coef * (w + 1)) - sum(coef * 4.0)) / nullif(abs(sum(coef * 4.0)), 0) AS residual FROM m GROUP BY target_id), b AS ({_PARTS.format('s')}), a AS ({_PARTS.format('late')}), h AS (SELECT *, {_u('target_id')} < 0.2 AS held FROM a), f AS (SELECT 'initial_loss' AS name, 0.9::DOUBLE AS baseline, true AS less, (SELECT coalesce(sum(part), 0) FROM b) AS candidate UNION ALL SELECT 'total_loss', 1.2, true, coalesce(sum(part), 0) FROM h UNION ALL SELECT 'train_loss', 0.6, true, coalesce(sum(part) FILTER (NOT held), 0) FROM h UNION ALL SELECT 'holdout_loss', 0.4, true, coalesce(sum(part) FILTER (held), 0) FROM h UNION ALL SELECT 'unweighted_msre', 0.5, true, coalesce(avg(residual * residual), 0) FROM h UNION ALL SELECT 'n_national_targets', 5, false, count(*) FILTER (geo_level = 'national') FROM h UNION ALL SELECT 'n_state_targets', 5, false, count(*) FILTER (geo_level = 'state') FROM h UNION ALL SELECT 'n_targets_kept', 10, false, count(*) FROM h), p AS (SELECT 'balance' AS name, 100000.0::DOUBLE AS baseline, sum(CAST(floor(abs(balance) * 100) AS BIGINT)) / 100.0::DOUBLE AS candidate, count(*) FILTER (balance <> 0) > 0 AS passed FROM hh UNION ALL SELECT 'nothing', 1.0, 0.0, false) SELECT 'measure' AS kind, name, baseline, candidate, candidate - baseline AS delta, CASE WHEN less THEN candidate <= baseline ELSE candidate = baseline END AS passed FROM f UNION ALL SELECT 'column', name, baseline, candidate, candidate - baseline, passed FROM p")
def score_against_baseline(spark, sf_dir):
    """A candidate, every weight one more than before, held against the figures of content/scoring.json."""
    frozen = manifests.load_scoring((CONTENT / "scoring.json").read_text())
    level = F.when(F.col("bucket") == "region", "state").otherwise(F.lit("national"))
    scored = lambda weights: K._scored(_matrix(spark, sf_dir), weights, _targets(spark, sf_dir)).withColumn("geo_level", level)
    before = _weights(spark, sf_dir)
    figures = scoring.measured(scored(before), scored(before.withColumn("w", F.col("w") + 1)), frozen.holdout_fraction, frozen.holdout_seed, frozen.settings.delta)
    profile = gates.sanity_profile(households(spark, sf_dir).select("balance", F.lit(0.0).alias("nothing")), ["balance", "nothing"])
    return scoring.verdict(figures, profile, frozen)


@query(f"WITH {_SCORED} SELECT target_id, value, 'state' AS geo_level FROM s WHERE bucket = 'region'")
def target_store_select(spark, sf_dir):
    """Targets written to a store, read back by ranges of row ids once the fingerprint is found right, and selected."""
    level = F.when(F.col("bucket") == "region", "state").otherwise(F.lit("national"))
    given = _targets(spark, sf_dir).select("target_id", "value", level.alias("geo_level"), F.lit(None).cast("string").alias("state_fips"), F.lit("zz").alias("country"), F.lit(2024).alias("model_year"), F.explode(F.array(F.lit("proxy"), F.lit("other"))).alias("profile"))
    path = f"{shared_dir(spark)}/targets-{uuid.uuid4().hex}.db"
    found = target_store.read_store(spark, path, sha256=target_store.write_store(given, path), rows=5)
    return K.select_targets(found, "zz", 2024, "proxy", "state").select("target_id", "value", "geo_level")


@query(f"WITH {_CELLS} SELECT target_id, unit, coef FROM m")
def loss_matrix(spark, sf_dir):
    return _matrix(spark, sf_dir)


@query(f"WITH {_CELLS} SELECT target_id, sum(coef * w) AS estimate FROM m GROUP BY target_id")
def target_estimates(spark, sf_dir):
    return K.estimates(_matrix(spark, sf_dir), _weights(spark, sf_dir))


@query(f"WITH {_SCORED} SELECT bucket, count(*) AS n_targets, CAST(avg(CASE WHEN abs(residual) <= 0.01 THEN 0.5 * residual * residual ELSE 0.01 * (abs(residual) - 0.005) END) AS DECIMAL(20, 12))::DOUBLE AS loss FROM s WHERE residual IS NOT NULL GROUP BY bucket")
def huber_bucketed(spark, sf_dir):
    return K.bucketed_loss(_scored(spark, sf_dir), "bucket", 0.01).withColumn("loss", F.col("loss").cast("decimal(20,12)").cast("double"))


@query(f"WITH {_SCORED} SELECT {_u('target_id')} < 0.2 AS is_holdout, count(*) AS n_targets, CAST(sum(residual * residual) AS DECIMAL(20, 12))::DOUBLE AS loss FROM s GROUP BY 1")
def loss_by_split(spark, sf_dir):
    scored = _scored(spark, sf_dir).withColumn("is_holdout", K.holdout("target_id", 0.2, SEED))
    return K.losses_by_split(scored, "is_holdout").withColumn("loss", F.col("loss").cast("decimal(20,12)").cast("double"))


@query(f"WITH {_SCORED} SELECT CAST(avg(pow(residual, 2)) AS DECIMAL(20, 12))::DOUBLE AS msre FROM s")
def msre(spark, sf_dir):
    return K.msre(_scored(spark, sf_dir)).withColumn("msre", F.col("msre").cast("decimal(20,12)").cast("double"))


@query(f"WITH {_SCORED} SELECT target_id, {_u('target_id')} < 0.2 AS is_holdout FROM s")
def holdout_split(spark, sf_dir):
    return _targets(spark, sf_dir).select("target_id", K.holdout("target_id", 0.2, SEED).alias("is_holdout"))


@query(f"WITH {_HH} SELECT household_id, nation FROM hh ORDER BY {_u('household_id')}, household_id LIMIT 500")
def matched_sample(spark, sf_dir):
    """A sampling operator: 500 records is its size."""
    return K.matched_sample(households(spark, sf_dir).select("household_id", "nation"), "household_id", 500, SEED)


@query(f"WITH {_SCORED}, n AS (SELECT bucket, count(*) AS n FROM s WHERE residual IS NOT NULL GROUP BY bucket), pull AS (SELECT target_id, greatest(-0.01, least(0.01, residual)) / (abs(value) * n) AS pull FROM s JOIN n USING (bucket) WHERE residual IS NOT NULL), g AS (SELECT unit, sum(coef * pull) AS g FROM m JOIN pull USING (target_id) GROUP BY unit) SELECT household_id AS unit, CAST(greatest(weight - 1000.0 * coalesce(g, 0), 0) AS DECIMAL(20, 9))::DOUBLE AS w FROM hh LEFT JOIN g ON unit = household_id")
def apg_one_step(spark, sf_dir):
    matrix, weights = _matrix(spark, sf_dir), _weights(spark, sf_dir)
    slopes = K.gradient(matrix, weights, _targets(spark, sf_dir), 0.01)
    return K.step(weights, slopes, 1000.0).withColumn("w", F.col("w").cast("decimal(20,9)").cast("double"))


@query(f"WITH {_HH}, moved AS (SELECT household_id AS unit, greatest(weight - 2, 0) AS w FROM hh) SELECT unit, w * ((SELECT sum(weight) FROM hh) / (SELECT sum(w) FROM moved)) AS w FROM moved")
def weight_total_preserve(spark, sf_dir):
    weights = _weights(spark, sf_dir)
    return K.preserve_total(weights.withColumn("w", F.greatest(F.col("w") - 2, F.lit(0.0))), weights)


@query()
def apg_calibrate(spark, sf_dir):
    """unit, w where the loss has converged; iterative, so without SQL."""
    return K.calibrate(_matrix(spark, sf_dir), _weights(spark, sf_dir), _targets(spark, sf_dir), K.Settings())[0]


@query(f"WITH {_CELLS} SELECT region, bracket, count(*) AS n FROM cells GROUP BY ROLLUP (region, bracket)")
def target_counts_rollup(spark, sf_dir):
    return K.target_counts(_cells(spark, sf_dir), ["region", "bracket"])


# gates


_PROFILE = "SELECT '{c}' AS \"column\", CAST(coalesce(sum(floor(abs({c}) * 100)) FILTER (isfinite({c})), 0) AS DOUBLE) / 100 AS abs_sum, coalesce(bool_and(coalesce(isfinite({c}), false)), false) AS finite, count(*) FILTER ({c} <> 0) AS nonzero_count, coalesce(bool_and(coalesce(isfinite({c}), false)), false) AND count(*) FILTER ({c} <> 0) > 0 AS passed FROM t"


@query("WITH t AS (SELECT c_acctbal, c_acctbal * 0 AS zero, CASE WHEN c_custkey % 100 = 0 THEN 'inf'::DOUBLE ELSE c_acctbal END AS endless, CASE WHEN c_custkey % 100 <> 0 THEN c_acctbal END AS gappy FROM customer) " + " UNION ALL ".join(_PROFILE.format(c=c) for c in ("c_acctbal", "zero", "endless", "gappy")))
def sanity_profile(spark, sf_dir):
    """One column passes; all zeros, an infinity and nulls fail."""
    balance, some = F.col("c_acctbal"), F.col("c_custkey") % 100 == 0
    rows = table(spark, sf_dir, "customer").select(balance, (balance * 0).alias("zero"), F.when(some, float("inf")).otherwise(balance).alias("endless"), F.when(~some, balance).alias("gappy"))
    return gates.sanity_profile(rows, ["c_acctbal", "zero", "endless", "gappy"])


@query("SELECT sha256(string_agg(n_name, chr(10) ORDER BY n_name)) AS digest FROM (SELECT DISTINCT n_name FROM nation)")
def name_digest(spark, sf_dir):
    return gates.name_digest(table(spark, sf_dir, "nation"), "n_name")


_LISTS = (("BUILDING", "required"), ("MACHINERY", "required"), ("SPACECRAFT", "required"), ("FURNITURE", "forbidden"), ("TOYS", "forbidden"), ("HOUSEHOLD", "optional"), ("AUTOMOBILE", "formula_owned"))
_CONTRACT = "k(\"column\", list) AS (VALUES " + ", ".join(f"('{c}', '{x}')" for c, x in _LISTS) + "), have AS (SELECT DISTINCT c_mktsegment AS \"column\" FROM customer)"


def _contract(spark, sf_dir):
    return spark.createDataFrame(_LISTS, "column string, list string"), table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("column")).distinct()


@query(f"WITH {_CONTRACT} SELECT \"column\" FROM k WHERE list = 'required' AND \"column\" NOT IN (SELECT \"column\" FROM have)")
def contract_missing(spark, sf_dir):
    contract, have = _contract(spark, sf_dir)
    return gates.failing(have, contract)[0]


@query(f"WITH {_CONTRACT} SELECT \"column\" FROM k WHERE list = 'forbidden' AND \"column\" IN (SELECT \"column\" FROM have)")
def contract_forbidden(spark, sf_dir):
    contract, have = _contract(spark, sf_dir)
    return gates.failing(have, contract)[1]


@query(f"WITH {_CONTRACT} SELECT coalesce(k.\"column\", have.\"column\") AS \"column\", CASE WHEN list = 'required' AND have.\"column\" IS NULL THEN 'missing' WHEN list = 'required' THEN 'ok' WHEN list = 'forbidden' AND have.\"column\" IS NOT NULL THEN 'forbidden' WHEN list = 'formula_owned' AND have.\"column\" IS NOT NULL THEN 'warn' WHEN list = 'optional' THEN 'ignored' WHEN list IS NULL THEN 'unknown' ELSE 'absent' END AS status FROM k FULL JOIN have ON k.\"column\" = have.\"column\"")
def contract_status(spark, sf_dir):
    contract, have = _contract(spark, sf_dir)
    return gates.status(have, contract)


@query(f"WITH {_HH} SELECT balance, household_id, nation, weight FROM hh")
def export_projection(spark, sf_dir):
    contract = gates.Contract(frozenset({"household_id", "weight", "nation", "balance"}), forbidden=frozenset({"segment"}))
    return gates.export_projection(households(spark, sf_dir), contract)
