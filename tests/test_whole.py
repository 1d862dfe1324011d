"""Queries that give the operator its whole tables."""

from claimgrid.plans import driver


def test_every_customer_with_an_experiment_is_mapped(spark, sf_dir):
    out = driver.QUERIES["sra_to_gsm"](spark, sf_dir)
    want = {f"GSM{r.c_custkey}" for r in driver.table(spark, sf_dir, "customer").collect() if r.c_custkey % 10}
    assert {r.entry for r in out.where("archive_id like 'SRX%'").collect()} == want
    assert out.where("archive_id like 'SRR%'").count()


def test_documents_of_every_language_are_scored(spark, sf_dir):
    assert driver.QUERIES["search_documents"](spark, sf_dir).count() == driver.table(spark, sf_dir, "documents").count()
    assert driver.QUERIES["search_documents_typed"](spark, sf_dir).count() == 20


def test_every_rule_of_the_contract_is_broken(spark, sf_dir):
    found = {(r.level, r.rule) for r in driver.QUERIES["contract_violations"](spark, sf_dir).select("level", "rule").distinct().collect()}
    both = {"ecode", "tissue ontology", "disease ontology", "sex", "age group", "organism"}
    assert found == {(x, r) for x in ("sample", "series") for r in both} | {("sample", f"several values of {a}") for a in ("sex", "age")}


def test_recursive_closure_of_more_than_a_million_paths(spark):
    from claimgrid.operators import ontology

    layers = [(f"{i}{a}", f"{i + 1}{b}") for i in range(19) for a in "xy" for b in "xy"]
    edges = spark.createDataFrame(layers, "parent string, child string")
    limit = spark.conf.get("spark.sql.cteRecursionRowLimit")
    got = {tuple(r) for r in ontology.closure_sql(edges).select("ancestor", "descendant").collect()}
    assert got == {tuple(r) for r in ontology.closure(edges).select("ancestor", "descendant").collect()}
    assert len(got) == 40 + 4 * 19 * 20 // 2 and spark.conf.get("spark.sql.cteRecursionRowLimit") == limit
