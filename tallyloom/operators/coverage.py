"""What is there and what is missing: weeks loaded, people gone, rows that can't be right, labels that are no people, goals' divisors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import calendar
from tallyloom.operators import people
from tallyloom.sources import facts
from tallyloom.sources.tables import parquet

#: Weeks away after which somebody counts as inactive; cents that a total may differ from its parts.
ABSENT, CENTS = 3, 2
# Labels of role groups in reports, and the last words of such labels.
ROLES = ("manager", "shift leader", "stylist", "total", "trainer", "front desk", "assistant", "grand total", "receptionist", "coach", "owner", "business coach", "franchise owner")
ROLE_ENDS = ("coach", "owner", "manager", "stylist", "leader", "trainer")
#: Words in an address and the place they stand for.
PLACES = (("www.example", "head office"), ("example", "franchise"), (".org", "charity"), (".net", "network"))


def missing_periods(loaded: DataFrame, entity: str, period: str) -> DataFrame:
    """(entity, period): weeks between an entity's first and last that it has no row for."""
    spans = loaded.groupBy(entity).agg(F.min(period).alias("first"), F.max(period).alias("last"))
    weeks = F.array_distinct(F.transform(F.sequence("first", "last"), facts.week_ending))
    return spans.select(entity, F.explode(weeks).alias(period)).join(loaded.select(entity, period).distinct(), [entity, period], "left_anti")


def longest_alias(text: Column, aliases: tuple[tuple[str, str], ...]) -> Column:
    """What the longest alias contained in the lower-cased text stands for; null for none. For a few aliases, as one expression."""
    out = F.lit(None).cast("string")
    for alias, name in sorted(aliases, key=lambda a: (len(a[0]), a[0])):
        out = F.when(F.contains(F.lower(text), F.lit(alias)), name).otherwise(out)
    return out


def is_role(name: Column) -> Column:
    """Labels of a group of people: known ones, known last words, or a word of over three capitals."""
    words = F.filter(F.split(F.trim(name), r"\s+"), lambda w: w != "")
    plain = F.lower(F.array_join(words, " "))
    return plain.isin(*ROLES) | F.coalesce(F.lower(F.try_element_at(words, F.lit(-1))).isin(*ROLE_ENDS), F.lit(False)) | F.exists(words, lambda w: (F.upper(w) == w) & (F.length(w) > 3))


def row_errors(required: list[str], amounts: list[str], parts: list[str], total: str) -> Column:
    """All that is wrong with a row, as text: missing values, negative amounts, and a total that isn't its parts'."""
    checks = [F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in required] + [F.when(F.col(c) < 0, F.lit(f"negative {c}")) for c in amounts]
    away = F.abs(sum((F.col(p) for p in parts[1:]), F.col(parts[0])) - F.col(total))
    return F.array_join(F.array_compact(F.array(*checks, F.when(away * 100 > CENTS, F.lit("total")))), "; ")


def missing_weeks(spark, sf_dir):
    return missing_periods(facts.stylist_weeks(spark, sf_dir), "stylist_name", "week_ending")


def week_coverage(spark, sf_dir):
    """Locations and stylists of each week against the roster."""
    p = facts.places(spark, sf_dir)
    roster = p.agg(F.countDistinct("loc_name")).scalar()
    rows = facts.stylist_weeks(spark, sf_dir).groupBy("week_ending").agg(F.countDistinct("loc_name").alias("n_locations"), F.count("*").alias("n_stylists"))
    return rows.withColumn("n_missing", roster - F.col("n_locations"))


def absence_states(spark, sf_dir):
    """Weeks since each person's last week, and whether that makes them inactive."""
    last = facts.visits(spark, sf_dir).groupBy("person").agg(facts.week_ending(F.max("day")).alias("last_week"))
    now = last.agg(F.max("last_week")).scalar()
    rows = last.withColumn("weeks_absent", F.floor(F.datediff(now, F.col("last_week")) / 7).cast("long"))
    return rows.withColumn("status", F.when(F.col("weeks_absent") >= ABSENT, "inactive").otherwise("active"))


def row_validation(spark, sf_dir):
    """Errors of stylist weeks of which some were spoilt: a negative amount, a lost count, or a total two cents or three off."""
    s = facts.stylist_weeks(spark, sf_dir).withColumn("k", F.day("week_ending") % 7)
    s = s.withColumn("total", F.col("service") + F.col("product") + F.when(F.col("k") == 1, F.lit("0.02").cast(facts.MONEY)).when(F.col("k") == 2, F.lit("0.03").cast(facts.MONEY)).otherwise(F.lit("0.00").cast(facts.MONEY)))
    s = s.withColumns({"guests": F.when(F.col("k") != 3, F.col("guests")), "prod_hours": F.when(F.col("k") == 4, -F.col("prod_hours")).otherwise(F.col("prod_hours"))})
    errors = row_errors(["stylist_name", "guests"], ["guests", "service", "product", "prod_hours"], ["service", "product"], "total")
    return s.select("stylist_name", "week_ending", errors.alias("errors"), (errors == "").alias("valid"))


def role_labels(spark, sf_dir):
    """Rendered labels, of people and of groups."""
    p, k = facts.places(spark, sf_dir), F.col("s_suppkey") % 6
    name = F.when(k == 0, "Shift  Leader").when(k == 1, "MANAGER").when(k == 2, "Business Coach").when(k == 3, "JJ Abe").when(k == 4, "").otherwise("Ann Lee")
    return p.select("stylist_name", name.alias("label"), is_role(name).alias("is_role"))


def alias_lookup(spark, sf_dir):
    return parquet(spark, sf_dir, "pages").select("page_id", longest_alias(F.col("url"), PLACES).alias("place"))


def goal_divisors(spark, sf_dir):
    """Working days that a month's goal was divided by, solved from the goal and its rounded share of a day, in whole cents."""
    m = facts.location_months(spark, sf_dir).select("loc_name", "year_month", ((F.col("service") + F.col("product")) * 100).cast("long").alias("goal"))
    first = calendar.month_start(F.col("year_month"))
    m = m.withColumn("days", calendar.working_days(first, F.last_day(first))).withColumn("daily", F.floor((F.col("goal") * 2 + F.col("days")) / (F.col("days") * 2)).cast("long"))
    m = m.where("daily > 0").withColumn("divisor", F.expr("(2 * goal + daily) div (2 * daily)"))
    return m.select("loc_name", "year_month", "goal", "daily", "divisor", (F.col("goal") - F.col("daily") * F.col("divisor")).alias("cents_left"), (F.col("divisor") == F.col("days")).alias("is_calendar"))


def manager_effect(spark, sf_dir):
    """What moves to a manager's locations change on average, and its class."""
    managers = facts.places(spark, sf_dir).select(F.col("loc_name").alias("to_loc"), "manager").distinct()
    m = people.moves(facts.visits(spark, sf_dir)).join(managers, "to_loc")
    change = lambda new, old: F.try_divide((F.col(new) - F.col(old)).cast("double"), F.col(old).cast("double"))
    out = m.groupBy("manager").agg(F.count("*").alias("n_moves"), F.round(F.avg(change("revenue", "prior_revenue")), 6).alias("ticket_effect"), F.round(F.avg(change("n_lines", "prior_lines")), 6).alias("guest_effect"))
    both = F.col("ticket_effect") + F.col("guest_effect")
    return out.withColumn("kind", F.when(both > 0.1, "positive").when(both < -0.1, "negative").otherwise("neutral"))


QUERIES = {f.__name__: f for f in (missing_weeks, week_coverage, absence_states, row_validation, role_labels, alias_lookup, goal_divisors, manager_effect)}

_ROLE = "CASE s_suppkey % 6 WHEN 0 THEN 'Shift  Leader' WHEN 1 THEN 'MANAGER' WHEN 2 THEN 'Business Coach' WHEN 3 THEN 'JJ Abe' WHEN 4 THEN '' ELSE 'Ann Lee' END"
_WEEK = "least({d} + (7 - isodow({d}))::INT, last_day({d}))"
ORACLE = {
    "missing_weeks": f"""WITH {facts.STYLISTS_SQL}, r AS (SELECT stylist_name, unnest(generate_series(min(week_ending), max(week_ending), INTERVAL 1 DAY))::DATE AS d FROM sw GROUP BY stylist_name)
SELECT DISTINCT stylist_name, {_WEEK.format(d="d")} AS week_ending FROM r EXCEPT SELECT stylist_name, week_ending FROM sw""",
    "week_coverage": f"""WITH {facts.STYLISTS_SQL} SELECT week_ending, count(DISTINCT loc_name) AS n_locations, count(*) AS n_stylists, (SELECT count(DISTINCT loc_name) FROM places) - count(DISTINCT loc_name) AS n_missing FROM sw GROUP BY 1""",
    "absence_states": f"""WITH {facts.VISITS_SQL}, l AS (SELECT person, {_WEEK.format(d="max(day)")} AS last_week FROM visits GROUP BY 1), a AS (SELECT *, ((SELECT max(last_week) FROM l) - last_week) // 7 AS weeks_absent FROM l)
SELECT *, CASE WHEN weeks_absent >= {ABSENT} THEN 'inactive' ELSE 'active' END AS status FROM a""",
    "row_validation": f"""WITH {facts.STYLISTS_SQL}, k AS (SELECT *, day(week_ending) % 7 AS k FROM sw)
SELECT stylist_name, week_ending, CASE k WHEN 2 THEN 'total' WHEN 3 THEN 'missing guests' WHEN 4 THEN CASE WHEN prod_hours > 0 THEN 'negative prod_hours' ELSE '' END ELSE '' END AS errors, NOT (k IN (2, 3) OR k = 4 AND prod_hours > 0) AS valid FROM k""",
    "role_labels": f"SELECT s_name AS stylist_name, {_ROLE} AS label, s_suppkey % 6 < 3 AS is_role FROM supplier",
    "alias_lookup": "SELECT page_id, CASE " + " ".join(f"WHEN contains(lower(url), '{a}') THEN '{n}'" for a, n in sorted(PLACES, key=lambda x: -len(x[0]))) + " END AS place FROM pages",
    "goal_divisors": f"""WITH {facts.MONTHS_SQL}, g AS (SELECT loc_name, year_month, ((service + product) * 100)::BIGINT AS goal, (SELECT count(*) FROM unnest(generate_series((year_month || '-01')::DATE, last_day((year_month || '-01')::DATE), INTERVAL 1 DAY)) t(d) WHERE isodow(d) < 7) AS days FROM lm),
d AS (SELECT *, (2 * goal + days) // (2 * days) AS daily FROM g), v AS (SELECT *, (2 * goal + daily) // (2 * daily) AS divisor FROM d WHERE daily > 0)
SELECT loc_name, year_month, goal, daily, divisor, goal - daily * divisor AS cents_left, divisor = days AS is_calendar FROM v""",
    "manager_effect": f"""WITH {people._MOVES}, t AS (SELECT manager, count(*) AS n_moves, round(avg((revenue - prior_revenue)::DOUBLE / nullif(prior_revenue::DOUBLE, 0)), 6) AS ticket_effect,
  round(avg((n_lines - prior_lines)::DOUBLE / nullif(prior_lines::DOUBLE, 0)), 6) AS guest_effect FROM moves JOIN (SELECT DISTINCT loc_name, manager FROM places) p ON to_loc = p.loc_name GROUP BY 1)
SELECT *, CASE WHEN ticket_effect + guest_effect > 0.1 THEN 'positive' WHEN ticket_effect + guest_effect < -0.1 THEN 'negative' ELSE 'neutral' END AS kind FROM t""",
}
