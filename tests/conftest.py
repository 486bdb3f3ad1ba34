import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small():
    if not os.path.isdir(SMALL):
        pytest.skip("no test tables")
    return SMALL


SCHEMAS = {
    "pages": "page_id BIGINT, volume_id INT, seq_no INT, path STRING, img_name STRING, height INT, width INT, scanned_at TIMESTAMP",
    "regions": "page_id BIGINT, region_id STRING, name STRING, coords ARRAY<STRUCT<x: INT, y: INT>>, bbox STRUCT<x_min: INT, y_min: INT, x_max: INT, y_max: INT>, conf DOUBLE, height INT, width INT",
    "line_texts": "line_uid BIGINT, page_id BIGINT, volume_id INT, region_id STRING, line_pos INT, polygon ARRAY<STRUCT<x: INT, y: INT>>, text STRING, conf DOUBLE, text_conf DOUBLE, row_length INT, recognised_at TIMESTAMP",
    "page_stats": "page_id BIGINT, img_name STRING, height INT, width INT, page_conf_mean DOUBLE, page_conf_median DOUBLE, page_conf_25 DOUBLE, page_conf_75 DOUBLE, n_long_rowtext BIGINT, language STRING, computed_at TIMESTAMP",
    "xml_out": "page_id BIGINT, xml_format STRING, target STRING, xml STRING, exported_at TIMESTAMP",
    "volumes": "volume_id INT, title STRING, year_from INT, year_to INT",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, volume_id INT, added_at TIMESTAMP",
    "benchmark": "item_id BIGINT, text STRING",
    "mix_targets": "source STRING, target_share DOUBLE, max_repeats INT",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP",
}


@pytest.fixture(scope="session")
def write_tables(spark, tmp_path_factory):
    """A data directory of the given rows (dicts by table); tables not given are empty.  Extra columns may be named."""

    def write(extra: str = "", **rows):
        d = tmp_path_factory.mktemp("tables")
        for name, ddl in SCHEMAS.items():
            full = ddl + (", " + extra if extra else "")
            columns = spark.createDataFrame([], full).columns
            data = [tuple(r.get(c) for c in columns) for r in rows.get(name, [])]
            spark.createDataFrame(data, full).coalesce(1).write.parquet(f"{d}/{name}.parquet")
        return str(d)

    return write
