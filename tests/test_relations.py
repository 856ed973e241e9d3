import datetime

from plumbline.operators.integrity import primary_key_check, reference_check
from plumbline.plans.checking import run_checks, stored_run
from plumbline.plans.policy import DateOrder, Reference, Sequence, TableRules
from plumbline.plans.relations import compile_relations, evaluate_domain, evaluate_relations
from plumbline.plans.rules import packaged_rules, parse_rules
from tests.test_checking import csv_rows

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return plan(df).count("Exchange hashpartitioning")


def results(parts):
    return {(r.table_name, r.column_name, r.check_type): (r.status, r.actual) for p in parts for r in p.collect()}


def tables(spark):
    parents = spark.createDataFrame([(1, "a", datetime.date(2024, 1, 5)), (2, "b", None), (2, "b", None), (None, "c", None)], "id bigint, word string, day date")
    long = "x" * 200
    children = spark.createDataFrame(
        [
            (1, "a", 1, datetime.date(2024, 1, 4)),
            (1, "b", 2, datetime.date(2024, 1, 6)),
            (2, long, 4, None),
            (9, long, 1, datetime.date(2024, 1, 1)),
            (9, None, 2, None),
            (None, "c", None, None),
        ],
        "Parent int, word string, n int, day date",
    )
    return {"p": parents, "c": children}


RULES = {
    "p": TableRules(primary_key=("id",)),
    "c": TableRules(
        primary_key=("parent", "n"),
        references=(Reference("PARENT", "p", "id"), Reference("word", "p", "word", "lookup"), Reference("x", "p", "id"), Reference("n", "gone", "id")),
        sequences=(Sequence("n", "parent"),),
        date_orders=(DateOrder("day", "p", "day", ("parent", "id")), DateOrder("other_day", "p", "day", ("parent", "id"))),
    ),
}


def test_all_kinds_over_odd_rows(spark):
    assert results(evaluate_relations(tables(spark), RULES)) == {
        ("p", "id", "primary_key"): ("FAIL", 1.0),
        ("c", "Parent, n", "primary_key"): ("PASS", 0.0),
        ("c", "Parent", "foreign_key"): ("FAIL", 2.0),
        ("c", "word", "lookup"): ("FAIL", 2.0),
        # Group 2 starts at 4; only a gap inside a group counts.
        ("c", "n", "sequence"): ("PASS", 0.0),
        ("c", "day", "date_order"): ("FAIL", 1.0),
        ("c", "x", "foreign_key"): ("SKIP", None),
        ("c", "n", "foreign_key"): ("SKIP", None),
        ("c", "other_day", "date_order"): ("SKIP", None),
    }


def test_sequences_with_and_without_groups(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 5), (2, 7), (2, 7), (None, 3), (3, None)], "g int, n bigint")
    for rule, gaps in ((Sequence("n", "g"), 1.0), (Sequence("n"), 2.0)):
        assert results(evaluate_relations({"t": df}, {"t": TableRules(sequences=(rule,))})) == {
            ("t", "n", "sequence"): ("FAIL", gaps)
        }
    for rule in (Sequence("n", "g"), Sequence("n")):
        empty = evaluate_relations({"t": df.limit(0)}, {"t": TableRules(sequences=(rule,))})
        assert set(results(empty).values()) == {("PASS", 0.0)}
    (skipped,) = evaluate_relations({"t": df}, {"t": TableRules(sequences=(Sequence("n", "absent"),))})
    assert skipped.first().status == "SKIP"


def test_rules_about_one_key_share_one_shuffle(spark):
    rules = packaged_rules("tpch")
    found = {t: spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in rules}
    domains, orders, skipped = compile_relations(found, rules)
    assert not skipped and len(orders) == 1
    kinds = {d.name: sorted(f.check_type for f in d.figures) for d in domains}
    assert kinds == {
        "orders.o_orderkey": ["foreign_key", "primary_key"],
        "customer.c_custkey": ["foreign_key", "primary_key"],
        "lineitem.l_orderkey+l_linenumber": ["primary_key", "sequence"],
        "nation.n_nationkey": ["lookup", "primary_key"],
        "events.event_id": ["primary_key"],
    }
    shared = {d.name: shuffles(evaluate_domain(found, d)) for d in domains}
    # The sequence also counts its groups, over the starts of its runs alone.
    assert shared.pop("lineitem.l_orderkey+l_linenumber") == 2
    assert set(shared.values()) == {1}
    orders, lines = found["orders"], found["lineitem"]
    apart = shuffles(primary_key_check(orders, "orders", ["o_orderkey"])) + shuffles(
        reference_check(lines, "l_orderkey", orders, "o_orderkey", "lineitem", "orders")
    )
    assert apart >= 3


def test_a_hot_key_is_one_row_per_task_before_the_shuffle(spark):
    (domain, *_), _, _ = compile_relations(tables(spark), RULES)
    text = plan(evaluate_domain(tables(spark), domain))
    assert text.index("Exchange hashpartitioning") < text.index("partial_sum(m0")


def test_configuration_names_all_kinds():
    entry = {
        "foreign_keys": {"a": "db.t.id"},
        "lookups": {"b": "u.id"},
        "sequences": {"n": None},
        "types": {"c": "date"},
        "date_order": {"d": {"not_before": "t.e", "on": ["a", "id"]}},
    }
    rule = parse_rules({"data_sources": {"s": {"tables": {"x": entry}}}})["x"]
    assert rule.references == (Reference("a", "db.t", "id"), Reference("b", "u", "id", "lookup"))
    assert rule.sequences == (Sequence("n"),) and rule.types == {"c": "date"}
    assert rule.date_orders == (DateOrder("d", "t", "e", ("a", "id")),)


def test_a_relation_that_cannot_be_judged_stops_no_other(spark, tmp_path):
    found = tables(spark)
    found["p"].write.parquet(str(tmp_path / "p"))
    found["c"].selectExpr("*", "map(1, 2) AS odd").write.parquet(str(tmp_path / "c"))
    rules = RULES | {"c": TableRules(references=(Reference("odd", "p", "id"), Reference("word", "p", "word")), freshness_hours=None)}
    refs = {name: str(tmp_path / name) for name in ("p", "c")}
    paths = run_checks(spark, refs, rules, str(tmp_path / "out"), "1", "2024-01-01")
    rows = {(r.table_name, r.column_name, r.check_type): r.status for r in stored_run(spark, paths).collect()}
    assert rows["c", "odd", "foreign_key"] == "ERROR" and rows["c", "word", "foreign_key"] == "FAIL"
    assert {r.table_name: r.overall_status for r in csv_rows(spark, paths["tables"])} == {"p": "ERROR", "c": "FAIL"}
