"""A source over the tables of a folder: customers, changed in turns, with a coded field, a multi-select and a reference to filtered nations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import EntityConfig
from ..operators.optionsets import SUFFIX
from .workflow import RawSource

DOCUMENT = """<edmx:Edmx xmlns:edmx="http://docs.oasis-open.org/odata/ns/edmx" Version="4.0"><edmx:DataServices>
<Schema xmlns="http://docs.oasis-open.org/odata/ns/edm" Namespace="shop">
<EntityType Name="party" Abstract="true"><Property Name="rank" Type="Edm.Int16"/></EntityType>
<EntityType Name="buyer"><Key><PropertyRef Name="buyerid"/></Key><Property Name="buyerid" Type="Edm.Guid" Nullable="false"/>
<Property Name="title" Type="Edm.String" MaxLength="30"/><Property Name="segment" Type="Edm.Int32"/><Property Name="picks" Type="Edm.String"/>
<Property Name="_land_value" Type="Edm.Guid"/><Property Name="modifiedon" Type="Edm.DateTimeOffset"/>
<NavigationProperty Name="land" Type="shop.land"><ReferentialConstraint Property="_land_value" ReferencedProperty="landid"/></NavigationProperty></EntityType>
<EntityType Name="land"><Key><PropertyRef Name="landid"/></Key><Property Name="landid" Type="Edm.Guid" Nullable="false"/><Property Name="title" Type="Edm.String" MaxLength="25"/></EntityType>
</Schema></edmx:DataServices></edmx:Edmx>"""
ENTITIES = [EntityConfig("buyer", "buyers"), EntityConfig("land", "lands", filtered=True)]


def buyers(customers: DataFrame, day: str, picks: str = "CASE c_custkey % 3 WHEN 0 THEN '1,2' WHEN 1 THEN '2,3' END") -> DataFrame:
    """seq, raw: the customers as records of one day."""
    chosen = F.expr(picks)
    label = F.translate(chosen, "123,", "ABC;")
    fields = {
        "buyerid": F.col("c_custkey").cast("string"), "title": F.col("c_name"), "segment": F.ascii("c_mktsegment"), f"segment{SUFFIX}": F.col("c_mktsegment"),
        "picks": chosen, f"picks{SUFFIX}": label, "_land_value": F.col("c_nationkey").cast("string"), "modifiedon": F.lit(day), "@odata.etag": F.concat(F.lit(day), F.col("c_custkey").cast("string")),
    }
    return customers.select(F.col("c_custkey").alias("seq"), F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()])).alias("raw"))


def source(spark: SparkSession, folder: str) -> RawSource:
    """The first turn: all customers and all nations."""
    nations = spark.read.parquet(f"{folder}/nation.parquet")
    lands = nations.select(F.col("n_nationkey").cast("long").alias("seq"), F.to_json(F.struct(F.col("n_nationkey").cast("string").alias("landid"), F.col("n_name").alias("title"))).alias("raw"))
    return RawSource(DOCUMENT, {"buyers": buyers(spark.read.parquet(f"{folder}/customer.parquet"), "2024-01-01"), "lands": lands})


def turn(spark: SparkSession, folder: str, where: str, day: str) -> DataFrame:
    """A later turn: the customers that changed; what they picked is one thing now."""
    return buyers(spark.read.parquet(f"{folder}/customer.parquet").where(where), day, "'3'")
