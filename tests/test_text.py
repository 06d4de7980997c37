"""Normal forms, tokens, keys: golden cases."""

from pyspark.sql import functions as F

from linkloom.functions import text as T
from linkloom.functions import unicode_text as U
from linkloom.operators import folds
from linkloom.operators.blocking import BASE, COMPOSITE
from linkloom.operators.records import prepare_records
from linkloom.sources.tables import store_uri

RECORD = "entity_id string, business_name string, business_address string, country string"


def one(spark, expression, *values):
    schema = ", ".join(f"c{k} string" for k in range(len(values)))
    return spark.createDataFrame([values], schema).select(expression(*[F.col(f"c{k}") for k in range(len(values))]).alias("x")).first()["x"]


def keys(spark, name, address, config, all_scripts=False):
    df = prepare_records(spark.createDataFrame([("a", name, address, "US")], RECORD), config, all_scripts=all_scripts)
    return {(k["kind"], k["value"]) for k in df.first()["block_keys"]}


def test_normal_forms(spark):
    assert one(spark, T.business_name, "Café North, Inc. Limited") == "cafe north" == U.plain_name("Café North, Inc. Limited")
    assert one(spark, T.business_address, "12 Élm Street, Suite 5") == "12 elm st ste 5"
    assert one(spark, T.business_name, "Inc Ltd") == "" and one(spark, T.business_name, None) == "" and one(spark, T.business_name, "Incwell AGCO") == "incwell agco"


def test_all_scripts():
    assert U.fold("राम मार्केटिंग") == "राम मार्केटिंग"
    assert U.name_view("Société Étoile SARL") == "societe etoile"
    assert U.core_name("ACME Pvt Ltd | www.acme.com") == "acme" and U.core_address("12 North Road, Suite 4") == "12 n rd ste 4"
    assert U.fold(None) == "" and U.romanised("Acme & Co") == "acme co" and U.romanised("Acme & Co", False) == "Acme & Co"


def test_base_keys(spark):
    got = keys(spark, "Café North Inc", "12 Elm Street, Boston MA 02110", BASE)
    want = {("exact_name", "cafe north"), ("exact_address", "12 elm st boston ma 02110"), ("postal_house", "02110|12"), ("name_token", "cafe"), ("name_gram", "caf")}
    assert want <= got and got == keys(spark, "Café North Inc", "12 Elm Street, Boston MA 02110", BASE, True)


def test_composite_keys(spark):
    a, b = (keys(spark, n, "15 Emerald Street, Springfield 62704", COMPOSITE) for n in ("Northwind Trading LLC", "Trading Northwind"))
    assert ("name_pair", "northwind|trading") in a & b
    assert {("name_house", "northwind|15"), ("house_address", "15|springfield"), ("compact_name", "northwindtrading"), ("name_place", "northwind|springfield")} <= a


def test_native_script_has_its_own_keys(spark):
    got = keys(spark, "राम Étoile", "12 Elm Street", COMPOSITE, True)
    assert ("exact_name", "राम etoile") in got


def test_keys_are_few(spark):
    name, address = (" ".join(f"{w}{k}" for k in range(60)) for w in ("name", "place"))
    assert len(keys(spark, name, "12 " + address + " 02110", BASE)) <= 18 and len(keys(spark, name, "12 " + address + " 02110", COMPOSITE, True)) <= 64
    assert keys(spark, "", "", COMPOSITE) == set()


def test_trigrams(spark):
    assert one(spark, lambda c: T.sampled_trigrams(c, 3), "abcdefgh") == ["abc", "cde", "fgh"]  # half to even
    assert one(spark, lambda c: T.sampled_trigrams(c, 4), "ab") == ["ab"] and one(spark, lambda c: T.sampled_trigrams(c, 4), "") == []
    assert one(spark, T.trigrams, "a b") == ["_a_", "a_b", "_b_"] and one(spark, T.trigrams, "") == []


def test_numbers(spark):
    assert one(spark, T.numbers, "12a 7 12 १२") == ["12", "7", "१२"]
    assert one(spark, lambda c: T.last_of_length(T.numbers(c), 5, 6), "1 12345 123456 7") == "123456"


def test_splits_cover_every_bucket_once(spark):
    for composite in (False, True):
        for smoke in (False, True):
            n, ranges = folds.split_ranges(composite, smoke)
            for at in range(n):
                assert sum(a <= at < b for a, b in ranges.values()) <= 1
    assert {at for a, b in folds.COMPOSITE_SPLITS.values() for at in range(a, b)} == set(range(100))
    got = spark.range(1000).select(folds.blake_fold(F.col("id").cast("string"), 6).alias("f")).groupBy("f").count().collect()
    assert len(got) == 6 and sum(r["count"] for r in got) == 1000


def test_store_uri():
    assert store_uri("s3://b/k", "s3a") == "s3a://b/k" and store_uri("s3a://b/k", "s3") == "s3://b/k" and store_uri("/tmp/x") == "/tmp/x"
    try:
        store_uri("s3://b", "gs")
    except ValueError:
        return
    raise AssertionError
