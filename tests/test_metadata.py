import json

import pytest

from tidemark.functions import types_map
from tidemark.model import Column, EntityConfig, ForeignKey, TableSchema
from tidemark.operators import closure, incremental, schema_diff
from tidemark.plans import report
from tidemark.sources import catalog, config, metadata
from tidemark.sources.store import create_table_sql, entity_schema

DOCUMENT = """<?xml version="1.0"?>
<edmx:Edmx xmlns:edmx="http://docs.oasis-open.org/odata/ns/edmx" Version="4.0"><edmx:DataServices>
<Schema xmlns="http://docs.oasis-open.org/odata/ns/edm" Namespace="harbour">
<EntityType Name="thing" Abstract="true"><Key><PropertyRef Name="thingid"/></Key><Property Name="thingid" Type="Edm.Guid"/><Property Name="weight" Type="Edm.Double"/></EntityType>
<EntityType Name="vessel"><Key><PropertyRef Name="vesselid"/></Key>
 <Property Name="vesselid" Type="Edm.Guid" Nullable="false"/><Property Name="callsign" Type="Edm.String" MaxLength="12"/>
 <Property Name="remarks" Type="Edm.String" MaxLength="Max"/><Property Name="berthstate" Type="Edm.Int32"/><Property Name="hull" Type="Edm.String"/>
 <Property Name="cargoes" Type="Edm.String"/><Property Name="modifiedon" Type="Edm.DateTimeOffset"/><Property Name="_pilot_value" Type="Edm.Guid"/>
 <Property Name="tonnage" Type="Edm.Int64"/><Property Name="dockid" Type="Edm.Guid"/>
 <NavigationProperty Name="pilot" Type="Collection(harbour.pilot)"><ReferentialConstraint Property="_pilot_value" ReferencedProperty="pilotid"/></NavigationProperty>
 <NavigationProperty Name="loose" Type="harbour.dock"/></EntityType>
<EntityType Name="pilot"><Key><PropertyRef Name="pilotid"/></Key><Property Name="pilotid" Type="Edm.Guid" Nullable="false"/><Property Name="badge" Type="Edm.String" MaxLength="40"/></EntityType>
</Schema></edmx:DataServices></edmx:Edmx>"""


def test_parse():
    schemas = metadata.parse(DOCUMENT, option_sets={"vessel": ["hull"]})
    assert set(schemas) == {"vessel", "pilot"}
    v = schemas["vessel"]
    types = {c.name: c.db_type for c in v.columns}
    assert v.primary_key == "vesselid" and types["hull"] == "INTEGER" and types["berthstate"] == "INTEGER" and types["callsign"] == "TEXT"
    assert {c.name: c.max_length for c in v.columns}["remarks"] is None and not v.columns[0].nullable
    assert v.foreign_keys == [ForeignKey("_pilot_value", "pilot", "pilotid"), ForeignKey("dockid", "dock", "dockid")]
    assert {c.name: c.db_type for c in metadata.parse(DOCUMENT, "postgresql")["vessel"].columns}["callsign"] == "VARCHAR(12)"
    with pytest.raises(ValueError, match="Failed to parse"):
        metadata.parse("<a>")
    assert metadata.requested(schemas, ["vessel", "nope"])[1] == ["nope"]


def test_types():
    assert types_map.db_type("Edm.String", "nonsense", is_option_set=True) == "INTEGER"
    with pytest.raises(ValueError, match="Unsupported"):
        types_map.db_type("Edm.String", "nonsense")
    assert types_map.normal_type("VARCHAR(100)") == "TEXT" and types_map.normal_type("numeric(10,2)", "postgres") == "NUMERIC"
    assert types_map.normal_type("x(1)", "oracle") == "X"
    assert Column("Name", "text") == Column("name", "TEXT") and Column("a", "TEXT") != Column("a", "TEXT", nullable=False)


def test_tables_and_keys():
    schema = metadata.parse(DOCUMENT)["vessel"]
    names = entity_schema(schema).fieldNames()
    assert names[0] == "row_id" and names[-4:] == ["json_response", "sync_time", "valid_from", "valid_to"]
    assert "vesselid TEXT NOT NULL" in create_table_sql("vessels", schema)
    assert incremental.resolve_key(schema, "vessel") == "vesselid"
    assert incremental.resolve_key(TableSchema("x", [Column("_aid", "TEXT"), Column("otherid", "TEXT")]), "x") == "otherid"
    with pytest.raises(ValueError):
        incremental.resolve_key(TableSchema("x", [Column("a", "TEXT")]), "x")
    with pytest.raises(ValueError, match="no column"):
        incremental.resolve_key(TableSchema("x", [Column("a", "TEXT")]), "x", {"xid": 1})
    assert incremental.order_column(TableSchema("x", [Column("modifiedon", "TEXT")])) == "modifiedon"
    filters = incremental.id_filters("k", [str(i) for i in range(120)], "2024")
    assert len(filters) == 3 and filters[0].endswith("and modifiedon gt 2024") and filters[2].count(" eq ") == 20


def test_edges():
    schemas = {"a": TableSchema("a", [Column("_b_value", "TEXT")], "aid", [ForeignKey("_b_value", "b", "bid"), ForeignKey("gone", "b", "bid"), ForeignKey("cid", "c", "cid")]), "b": TableSchema("b", [Column("bid", "TEXT")], "bid")}
    found, dropped = closure.edges(schemas, [EntityConfig("a", "as"), EntityConfig("b", "bs")])
    assert found == [("as", "_b_value", "bs", "bid")] and dropped == [("as", "gone", "bs", "bid")]
    assert closure.referencing(found, "bs") == [("as", "_b_value")] and closure.referenced_by(found, "as") == [("bs", "bid")]


def test_system_columns():
    stored = TableSchema("vessels", [Column("row_id", "INTEGER"), Column("vesselid", "TEXT"), Column("valid_to", "TEXT")], "row_id")
    assert schema_diff.without_system_columns(stored, "vesselid").primary_key == "vesselid"
    seen = schema_diff.without_system_columns(stored, "pilotid", "vessel")
    assert seen.primary_key == "vesselid" and [c.name for c in seen.columns] == ["vesselid"]
    assert schema_diff.with_real_key(TableSchema("vessel", [Column("vesselid", "TEXT")], "pilotid"), seen, "vessel").primary_key == "vesselid"


def test_compare(spark):
    e = {"t": TableSchema("t", [Column("id", "TEXT"), Column("count", "INTEGER"), Column("new", "TEXT")], "id", [ForeignKey("r", "x", "xid")]), "missing": TableSchema("missing")}
    a = {"t": TableSchema("t", [Column("ID", "VARCHAR(9)"), Column("count", "TEXT", nullable=False), Column("old", "TEXT")], "other"), "extra": TableSchema("extra")}
    found = schema_diff.compare(spark, e, a)
    kinds = sorted((r["issue_type"], r["severity"]) for r in found.collect())
    assert kinds == [("extra_column", "warning"), ("extra_table", "warning"), ("fk_missing", "info"), ("missing_column", "info"), ("missing_table", "info"), ("nullable_mismatch", "warning"), ("pk_mismatch", "error"), ("type_mismatch", "error")]
    assert not schema_diff.passes(found) and schema_diff.passes(schema_diff.compare(spark, {"t": e["t"]}, {"t": e["t"]}))
    rows = report.collected(found)
    assert json.loads(report.as_json(rows, set(e), set(a)))["summary"]["errors"] == 2
    assert "2 errors" in report.as_markdown(rows, set(e), set(a)) and report.console(rows)[1] is False


def test_config(tmp_path):
    p = tmp_path / "e.json"
    p.write_text('{"entities": [{"name": "vessel"}, {"name": "city", "api_name": "cities", "filtered": true}]}')
    assert [(e.api_name, e.filtered) for e in config.load_entities(str(p))] == [("vessels", False), ("cities", True)]
    p.write_text('{"entities": 3}')
    with pytest.raises(ValueError):
        config.load_entities(str(p))
    p.write_text('{"a": "b"}')
    with pytest.raises(ValueError):
        config.load_option_sets(str(p))
    assert config.load_option_sets(None) == {}
    env = tmp_path / "env"
    env.write_text("# x\nDATAVERSE_API_URL='https://h/api/'\nDATAVERSE_CLIENT_ID=i\nDATAVERSE_CLIENT_SECRET=s\n")
    with pytest.raises(ValueError, match="DATAVERSE_SCOPE"):
        config.load_settings(str(env), {})
    assert config.load_settings(str(env), {"DATAVERSE_SCOPE": "q"}).api_url == "https://h/api"


def test_postgres_views_with_one_constraint_name_on_two_tables(spark):
    make = lambda rows, kind: spark.createDataFrame([("public", *r) for r in rows], "table_schema string, " + kind)
    columns = [("ship", "a", "integer", "NO", None, 1), ("ship", "b", "integer", "NO", None, 2), ("ship", "title", "character varying", "YES", 40, 3), ("trip", "id", "integer", "NO", None, 1), ("trip", "ship_b", "integer", "YES", None, 2), ("trip", "ship_a", "integer", "YES", None, 3), ("trip", "port", "integer", "YES", None, 4), ("port", "id", "integer", "NO", None, 1)]
    held = [("ship", "key", "PRIMARY KEY"), ("trip", "key", "PRIMARY KEY"), ("port", "port_key", "PRIMARY KEY"), ("trip", "of_ship", "FOREIGN KEY"), ("trip", "of_port", "FOREIGN KEY")]
    used = [("ship", "key", "b", 2, None), ("ship", "key", "a", 1, None), ("trip", "key", "id", 1, None), ("port", "port_key", "id", 1, None), ("trip", "of_ship", "ship_a", 1, 1), ("trip", "of_ship", "ship_b", 2, 2), ("trip", "of_port", "port", 1, 1)]
    target = [("ship", "key", "a"), ("ship", "key", "b"), ("trip", "key", "id"), ("port", "port_key", "id"), ("ship", "of_ship", "a"), ("ship", "of_ship", "b"), ("port", "of_port", "id")]
    views = {
        "columns": make(columns, "table_name string, column_name string, data_type string, is_nullable string, character_maximum_length int, ordinal_position int"),
        "table_constraints": make(held, "table_name string, constraint_name string, constraint_type string"),
        "key_column_usage": make(used, "table_name string, constraint_name string, column_name string, ordinal_position int, position_in_unique_constraint int"),
        "constraint_column_usage": make(target, "table_name string, constraint_name string, column_name string"),
    }
    got = catalog.postgres_schemas(views)
    assert [got[t].primary_key for t in ("ship", "trip", "port")] == ["a", "id", "id"]
    assert got["trip"].foreign_keys == [ForeignKey("port", "port", "id"), ForeignKey("ship_a", "ship", "a"), ForeignKey("ship_b", "ship", "b")]
    assert got["ship"].columns[2] == Column("title", "CHARACTER VARYING", "", True, 40) and not got["ship"].foreign_keys
