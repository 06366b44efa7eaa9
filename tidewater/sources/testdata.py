"""Typed parquet scans of the given tables.

Every table is read with an explicit schema (no inference), so a scan is
just metadata plus the columns a query touches: Catalyst prunes the read
schema and pushes filters into the parquet reader.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_L, _I, _D, _S, _TS = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


SCHEMAS: dict[str, T.StructType] = {
    "region": _schema(("r_regionkey", _I), ("r_name", _S)),
    "nation": _schema(("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)),
    "customer": _schema(("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I),
                        ("c_acctbal", _D), ("c_mktsegment", _S)),
    "supplier": _schema(("s_suppkey", _L), ("s_name", _S), ("s_nationkey", _I), ("s_acctbal", _D)),
    "part": _schema(("p_partkey", _L), ("p_name", _S), ("p_brand", _S), ("p_type", _S),
                    ("p_size", _I), ("p_retailprice", _D)),
    "orders": _schema(("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S),
                      ("o_totalprice", _D), ("o_orderdate", _TS), ("o_orderpriority", _S)),
    "lineitem": _schema(("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L), ("l_linenumber", _I),
                        ("l_quantity", _D), ("l_extendedprice", _D), ("l_discount", _D), ("l_tax", _D),
                        ("l_returnflag", _S), ("l_linestatus", _S), ("l_shipdate", _TS)),
    "events": _schema(("event_id", _L), ("ts", _TS), ("user_id", _L), ("event_type", _S),
                      ("value", _D), ("props", _S)),
}

# Tables with a size fixed by the TPC-H specification (5 regions, 25 nations):
# the only base tables that may be broadcast without a size check.
FIXED_SIZE = frozenset({"region", "nation"})


class TestData:
    """Lazy handles on the parquet tables of one scale-factor folder."""

    __test__ = False  # not a pytest class

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        reader = self.spark.read
        if name in SCHEMAS:
            reader = reader.schema(SCHEMAS[name])
        return reader.parquet(f"{self.sf_dir}/{name}.parquet")

    def n_bytes(self) -> int:
        """Bytes of the files of the tables that the folder has, from a listing."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        total = 0
        for name in SCHEMAS:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.sf_dir}/{name}.parquet")
            fs = path.getFileSystem(conf)
            if fs.exists(path):
                total += fs.getContentSummary(path).getLength()
        return total

    @cached_property
    def region(self) -> DataFrame:
        return self.table("region")

    @cached_property
    def nation(self) -> DataFrame:
        return self.table("nation")

    @cached_property
    def customer(self) -> DataFrame:
        return self.table("customer")

    @cached_property
    def supplier(self) -> DataFrame:
        return self.table("supplier")

    @cached_property
    def part(self) -> DataFrame:
        return self.table("part")

    @cached_property
    def orders(self) -> DataFrame:
        return self.table("orders")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.table("lineitem")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")
