from __future__ import annotations

import json

import pytest

from millrace import ColumnSpec, DatasetSpec, TableSpec, load_spec

RAW = {
    "nm": "orders",
    "ver": "3",
    "src_prefix": "/in/orders",
    "format": "csv",
    "cols": [
        {
            "src_nm": "A",
            "tgt_nm": "a",
            "src_dtype": "string",
            "tgt_dtype": "int",
            "nullable": False,
            "regex": "^x",
            "sensitivity": "pii",
        },
        {"src_nm": "b", "tgt_nm": "b", "src_dtype": "int", "tgt_dtype": "int", "regex": None},
    ],
}


def test_defaults():
    spec = DatasetSpec.from_dict({"ds": RAW})
    assert spec.columns[0] == ColumnSpec("A", "a", "string", "int", False, "^x", "pii")
    assert spec.columns[1] == ColumnSpec("b", "b", "int", "int", True, "", None)
    assert spec.columns[0].is_cast and not spec.columns[1].is_cast
    assert (spec.id_columns, spec.update_columns, spec.where) == ((), (), "")
    assert (spec.check_schema, spec.allow_extra_columns, spec.allow_missing_columns) == (
        True,
        True,
        False,
    )
    assert spec.domicile == "global" and spec.table is None and spec.dq_mode == "flag"


@pytest.mark.parametrize(
    "given, tag",
    [(None, "global"), (" NULL ", "global"), ("none", "global"), ("", "global"), (" EU ", "eu")],
)
def test_dataset_tag_is_normalized(given, tag):
    assert DatasetSpec.from_dict({**RAW, "domicile": given}).domicile == tag


def test_table_only_when_enabled():
    table = {"catalog": "c", "database": "d", "table": "t"}
    assert DatasetSpec.from_dict({**RAW, "iceberg": {**table, "enabled": False}}).table is None
    spec = DatasetSpec.from_dict({**RAW, "iceberg": {**table, "enabled": True}})
    assert spec.table == TableSpec("c", "d", "t", ("domicile",), "iceberg")


def test_merge_keys():
    spec = DatasetSpec.from_dict({**RAW, "id_cols": ["a"]})
    assert spec.merge_keys() == ("a", "domicile")
    tagged = DatasetSpec.from_dict({**RAW, "id_cols": ["domicile", "a"]})
    assert tagged.merge_keys() == ("domicile", "a")
    with pytest.raises(ValueError, match="id_cols"):
        DatasetSpec.from_dict(RAW).merge_keys()


@pytest.mark.parametrize("key", ["src_nm", "tgt_nm"])
def test_columns_declared_twice(key):
    twice = [{**c, key: "same"} for c in RAW["cols"]]
    with pytest.raises(ValueError, match="declared twice: same"):
        DatasetSpec.from_dict({**RAW, "cols": twice})


def test_unknown_quality_mode():
    with pytest.raises(ValueError, match="dq_mode"):
        DatasetSpec.from_dict({**RAW, "dq_rules": {"mode": "best effort"}})


def test_load_spec_from_file(spark, tmp_path):
    file = tmp_path / "orders_feed.json"
    file.write_text(json.dumps({"ds": {**RAW, "nm": None}}, indent=2))
    spec = load_spec(spark, str(file))
    assert spec.name == "orders_feed"
    assert spec.columns == DatasetSpec.from_dict(RAW).columns


def test_empty_spec_file(spark, tmp_path):
    file = tmp_path / "empty.json"
    file.write_text("")
    with pytest.raises(ValueError, match="empty"):
        load_spec(spark, str(file))
