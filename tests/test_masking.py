import pytest
from pyspark.sql import functions as F

from topicflow.operators.mask import Mask, mask


def one(df, name="v"):
    return [r[name] for r in df.collect()]


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def test_fixed_mask_keeps_nulls_and_hides_empty_text(spark):
    assert one(mask(texts(spark, "abc", "", None), "v")) == ["*****", "*****", None]


# Hashes that have to be met.
def test_sha1_vectors(spark):
    got = one(mask(texts(spark, "this is a test", "bob", "mr", None), "v", "sha1"))
    assert got == [
        "9938a75e6d10a74d6b2e9bc204177de5b95f28fe",
        "61584b76f6ece8fb9a328e7cf198094b2fac55c7",
        "fad7ad45e60072e88f86727c4b4adc9607de86e3",
        None,
    ]


# Hashes that have to be met.
def test_sha512_salts_every_value(spark):
    bob, mr, none = one(mask(texts(spark, "bob", "mr", None), "v", "sha512", salt="pepper"))
    assert bob.startswith("7dd03041fa190b49639a") and len(bob) == 128
    assert mr.startswith("b96364d6d230da4b610d")
    assert none is None
    (value,) = one(mask(texts(spark, "myfieldvalue"), "v", "sha512", salt="something"))
    assert value.startswith("ade2426de954b6cd28ce")


def test_random_salt_differs_for_every_value(spark):
    df = spark.range(50).select(F.lit("x").alias("v"), F.array(F.lit("x"), F.lit("x")).alias("w"))
    rows = mask(df, "v,w.value", "sha512", random_salt=True).collect()
    found = {r.v for r in rows} | {x for r in rows for x in r.w}
    assert len(found) == 150 and all(len(x) == 128 for x in found)


TEAM = (
    "name string, tags array<string>, deep array<array<struct<a: string, b: int>>>, "
    "players array<struct<name: string, number: int, club: struct<city: string>>>"
)


def team(spark):
    data = [
        ("reds", ["x", None], [[("p", 1), None], None], [("ann", 1, ("rome",)), None, (None, 2, None)]),
        (None, None, None, None),
    ]
    return spark.createDataFrame(data, TEAM)


def test_masks_inside_lists_and_keeps_null_elements(spark):
    paths = "players.value.name, players.value.club.city, tags.value, deep.value.value.a, absent.x"
    first, second = mask(team(spark), paths).orderBy(F.col("name").isNull()).collect()
    assert first["tags"] == ["*****", None]
    assert first["deep"][0][0]["a"] == "*****" and first["deep"][0][0]["b"] == 1
    assert first["deep"][0][1] is None and first["deep"][1] is None
    assert first["players"][0]["name"] == "*****" and first["players"][0]["club"]["city"] == "*****"
    assert first["players"][1] is None and first["players"][2]["name"] is None
    assert first["players"][2]["club"] is None and first["players"][2]["number"] == 2
    assert first["name"] == "reds"
    assert second["players"] is None and second["tags"] is None


@pytest.mark.parametrize(
    "paths",
    [
        "players.value.number",  # not text
        "players.value.club",  # stops at an object
        "name.more",  # goes below text
        "players.name",  # lacks the list step
        "players",
        "name,name.more",  # two paths on one text
        "players.value,players.value.name",  # overlap in a list
        "deep.value.a",
    ],
)
def test_rejects_bad_paths(spark, paths):
    with pytest.raises(ValueError):
        mask(team(spark), paths)


def test_mask_options():
    assert Mask(" a , b,a,").fields == ("a", "b")
    for bad in (dict(fields=" , "), dict(fields="a", method="md5"), dict(fields="a", method="sha512")):
        with pytest.raises(ValueError):
            Mask(**bad)
    assert Mask("a", "SHA512", random_salt=True).method == "sha512"
