"""Keyed tokens (L9): equal to Python's hmac, key versions, token table, rotation, no key in a plan."""

import hashlib
import hmac

import pytest

from lakepipe.operators import tokens
from lakepipe.operators.tokens import Tokens

KEYS = {1: b"old key", 2: b"k" * 100}            # the second is longer than a block
IDS = ["FI001", "", "Zürich", "FI001", None]


def expected(version: int, text: str | None) -> str | None:
    return None if text is None else f"{version}." + hmac.new(KEYS[version], text.encode(), hashlib.sha256).hexdigest()


@pytest.fixture
def ids(spark):
    return spark.createDataFrame([(i, x) for i, x in enumerate(IDS)], "n int, id string")


def test_tokens_equal_hmac(spark, ids):
    t = Tokens(spark, KEYS)
    got = ids.select("n", t.of("id").alias("now"), t.of("id", 1).alias("before")).orderBy("n").collect()
    assert [(r["now"], r["before"]) for r in got] == [(expected(2, x), expected(1, x)) for x in IDS]


def test_keys_come_from_the_session_and_are_in_no_plan(spark, ids, capsys):
    with pytest.raises(ValueError):
        Tokens(spark)
    spark.conf.set(tokens.KEYS_CONF, ",".join(f"{v}:{k.hex()}" for v, k in KEYS.items()))
    try:
        t = Tokens(spark)
    finally:
        spark.conf.unset(tokens.KEYS_CONF)
    assert t.keys == KEYS and t.current == 2
    ids.select(t.of("id")).explain("extended")
    plan = capsys.readouterr().out
    inner, outer = tokens.pads(KEYS[2])
    assert not any(x in plan for x in (KEYS[2].decode(), KEYS[2].hex(), inner.hex().upper(), outer.hex().upper(), inner.decode("latin-1")))


def test_a_key_for_every_version(spark):
    with pytest.raises(ValueError):
        Tokens(spark, {1: b""})


def test_token_table_has_one_row_an_id(spark, ids):
    table = Tokens(spark, KEYS).table(ids, "id").collect()
    assert sorted((r["key_version"], r["id"], r["token"]) for r in table) == sorted(
        (2, x, expected(2, x)) for x in {"FI001", "", "Zürich"})


def test_rotation_joins_old_to_new_without_the_ids(spark, ids):
    old, new = Tokens(spark, {1: KEYS[1]}), Tokens(spark, KEYS)
    stored = old.replace(ids, ["id"]).union(spark.createDataFrame([(9, "no token")], "n int, id string"))
    moved = tokens.rotate(stored, "id", new.rotation(old.table(ids, "id")))
    assert {r["n"]: r["id"] for r in moved.collect()} == {i: expected(2, x) for i, x in enumerate(IDS)} | {9: "no token"}
    shown = tokens.reveal(moved, "id", new.table(ids, "id"), "raw")
    assert {r["n"]: r["raw"] for r in shown.collect()} == dict(enumerate(IDS)) | {9: None}
    assert new.rotation(new.table(ids, "id")).count() == 0


def test_empty_table(spark, ids):
    t, none = Tokens(spark, KEYS), ids.limit(0)
    assert t.replace(none, ["id"]).columns == ["n", "id"] and t.table(none, "id").count() == 0
