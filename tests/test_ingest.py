import dataclasses
import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F

from silverlode.session import scratch_path
from silverlode.sources import bronze, headers
from silverlode.sources.specs import RESCUED, SOURCES, sources
from silverlode.streaming.ingest import ingest_stream, new_files

GEO = next(s for s in SOURCES if s.table == "erp_loc_a101")
CAT = next(s for s in SOURCES if s.table == "erp_px_cat_g1v2")
NOW = dt.datetime(2026, 1, 1)


class Lake:
    def __init__(self, spark, base):
        self.spark, self.base = spark, pathlib.Path(base)
        self.landing, self.bronze, self.checkpoints = (str(self.base / n) for n in ("landing", "bronze", "checkpoints"))

    def land(self, name, content):
        path = self.base / "landing" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content if isinstance(content, bytes) else content.encode())

    def load(self, spec=GEO, mode="append", batch="b1", **more):
        return bronze.load_batch(self.spark, spec, self.landing, self.bronze, mode, batch, NOW, **more)

    def rows(self, spec=GEO, *columns):
        df = bronze.read_bronze(self.spark, self.bronze, spec.table).select(*(columns or spec.columns))
        return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def lake(spark):
    return Lake(spark, scratch_path(spark, "test-lake"))


def test_lineage_and_strings(spark, lake):
    lake.land("source_erp/LOC_A101.csv", "CID,CNTRY\r\nAW-1,US\r\nAW-2,\r\n007,1e3\r\n")
    done = lake.load(mode="overwrite")
    assert (done.row_count, done.rescued_row_count, done.file_count) == (3, 0, 1)
    assert lake.rows() == [("007", "1e3"), ("AW-1", "US"), ("AW-2", None)]
    one = bronze.read_bronze(spark, lake.bronze, GEO.table).first()
    assert (one._ingested_at, one._source_file, one._source_system, one._batch_id) == (NOW, "LOC_A101.csv", "erp", "b1")


def test_batch_id_stays_text(lake):
    lake.land("source_erp/LOC_A101.csv", "CID,CNTRY\nAW-1,US\n")
    lake.load(batch="0012")
    assert lake.rows(GEO, "_batch_id") == [("0012",)]


def test_rescued_rows(lake):
    lake.land("source_erp/LOC_A101.csv", "CID,CNTRY\nAW-1,US\nAW-2\nAW-3,DE,extra\n")
    assert lake.load().rescued_row_count == 2
    assert lake.rows(GEO, "CID", RESCUED) == [("AW-1", None), ("AW-2", "AW-2"), ("AW-3", "AW-3,DE,extra")]


def test_quoted_fields(lake):
    lake.land("source_erp/LOC_A101.csv", 'CID,CNTRY\nAW-1,"Korea, South"\nAW-2,"a ""b"""\n')
    lake.load()
    assert lake.rows() == [("AW-1", "Korea, South"), ("AW-2", 'a "b"')]


def test_header_gate(spark, lake):
    lake.land("source_erp/LOC_A101_a.csv", b"\xef\xbb\xbfCID, CNTRY \nAW-1,US\n")  # byte-order mark, padding
    lake.land("source_erp/LOC_A101_b.csv", "CNTRY,CID\nDE,AW-2\n")  # other order
    lake.land("source_erp/LOC_A101_c.csv", "CID,LAND\nAW-3,FR\n")  # column missing
    lake.land("source_erp/LOC_A101_d.csv", "CID,CNTRY,CID\nAW-4,FR,x\n")  # column twice
    assert lake.load().file_count == 2
    assert lake.rows() == [("AW-1", "US"), ("AW-2", "DE")]
    log = bronze.read_log(spark, lake.bronze, "ingest_quarantine").orderBy("_source_file").collect()
    assert [(r._source_table, r._source_file) for r in log] == [(GEO.table, "LOC_A101_c.csv"), (GEO.table, "LOC_A101_d.csv")]
    assert log[0]._reason == "missing required column(s): CNTRY"
    found = headers.check_headers(spark, GEO, lake.landing).orderBy("file").collect()
    assert [r.missing for r in found] == [[], [], ["CNTRY"], []]


def test_append_loads_each_file_once(lake):
    lake.land("source_erp/LOC_A101.csv", "CID,CNTRY\nAW-1,US\n")
    assert lake.load(batch="b1").row_count == 1
    assert lake.load(batch="b2").row_count == 0
    lake.land("source_erp/LOC_A101.csv", "CID,CNTRY\nAW-1,US\nAW-2,DE\n")  # a new delivery under the old name
    assert lake.load(batch="b3").row_count == 2
    assert lake.rows(GEO, "CID", "_batch_id") == [("AW-1", "b1"), ("AW-1", "b3"), ("AW-2", "b3")]


def test_overwrite_replaces_all_batches(lake):
    lake.land("source_erp/LOC_A101.csv", "CID,CNTRY\nAW-1,US\n")
    lake.load(batch="b1")
    lake.load(batch="b2", mode="overwrite")
    assert lake.rows(GEO, "CID", "_batch_id") == [("AW-1", "b2")]
    with pytest.raises(ValueError):
        lake.load(batch="b3", mode="merge")


def test_replayed_batch_id_rewrites_itself(spark, lake):
    lake.land("source_erp/LOC_A101.csv", "CID,CNTRY\nAW-1,US\n")
    files = headers.list_files(spark, GEO.path(lake.landing)).collect()
    for _ in range(2):
        bronze.load_files(spark, GEO, files, lake.bronze, "b1")
    assert lake.rows() == [("AW-1", "US")]


def test_additional_column(lake):
    lake.land("source_erp/LOC_A101_a.csv", "CID,CNTRY\nAW-1,US\n")
    lake.load(batch="b1", keep_extra=True)
    lake.land("source_erp/LOC_A101_b.csv", "CID,REGION,CNTRY\nAW-2,EU,DE\n")
    lake.load(batch="b2", keep_extra=True)
    assert lake.rows(GEO, "CID", "CNTRY", "REGION") == [("AW-1", "US", None), ("AW-2", "DE", "EU")]


def test_one_bad_extract_does_not_stop_the_others(spark, lake):
    lake.land("source_erp/LOC_A101.csv", "CID,CNTRY\nAW-1,US\nAW-2,DE\n")
    lake.land("source_erp/PX_CAT_G1V2.csv", "ID,CAT,SUBCAT,MAINTENANCE\nAC_BR,A,B,Yes")  # no final newline
    loads = bronze.ingest_all(spark, lake.landing, lake.bronze, "erp", batch_id="b1")
    assert sorted((x.table, x.row_count) for x in loads) == [("erp_cust_az12", 0), ("erp_loc_a101", 2), ("erp_px_cat_g1v2", 1)]
    log = bronze.read_log(spark, lake.bronze, "ingest_quarantine").collect()
    assert [(r._source_table, r._source_file) for r in log] == [("erp_cust_az12", "CUST_AZ12*.csv")]
    audit = bronze.read_log(spark, lake.bronze, "ingest_audit")
    assert [tuple(r) for r in bronze.audit_totals(audit, "b1").collect()] == [("erp", 3)]
    with pytest.raises(bronze.EmptyLoadError, match="erp_cust_az12"):
        bronze.assert_loaded(loads)
    lake.land("source_erp/CUST_AZ12.csv", "CID,BDATE,GEN\nNASA1,1970-01-01,F\n")
    bronze.assert_loaded(bronze.ingest_all(spark, lake.landing, lake.bronze, "erp", batch_id="b2"))
    bronze.assert_loaded(bronze.ingest_all(spark, lake.landing, lake.bronze, "erp", batch_id="b3"))  # nothing new


def test_gate_sees_a_refused_file(lake):
    lake.land("source_erp/LOC_A101.csv", "CID\nAW-1\n")
    refused = lake.load()
    assert "missing required column(s): CNTRY" in refused.problem
    with pytest.raises(bronze.EmptyLoadError, match="CNTRY"):
        bronze.assert_loaded([refused])


def test_line_break_inside_quotes(lake):
    spec = dataclasses.replace(GEO, multi_line=True)
    lake.land("source_erp/LOC_A101.csv", 'CID,CNTRY\nAW-1,"a\nb"\nAW-2,DE\n')
    assert lake.load(spec).rescued_row_count == 0
    assert lake.rows() == [("AW-1", "a\nb"), ("AW-2", "DE")]


def test_summary(spark, lake):
    lake.land("source_erp/LOC_A101_a.csv", "CID,CNTRY\nAW-1,US\n")
    lake.land("source_erp/LOC_A101_b.csv", "CID,CNTRY\nAW-2\n")
    lake.load()
    got = bronze.summarise(bronze.read_bronze(spark, lake.bronze, GEO.table)).first()
    assert tuple(got) == (2, 1, 1, 2, NOW, NOW)


def test_system_filter():
    assert {s.system for s in sources("erp")} == {"erp"} and len(sources()) == 6
    with pytest.raises(ValueError):
        sources("hr")


def test_stream_loads_each_file_once(spark, lake):
    def run(per_trigger=8):
        return ingest_stream(spark, GEO, lake.landing, lake.bronze, lake.checkpoints, per_trigger)

    for n in range(3):
        lake.land(f"source_erp/LOC_A101_{n}.csv", f"CID,CNTRY\nAW-{n},US\n")
    lake.land("source_erp/LOC_A101_bad.csv", "CID\nAW-9\n")
    assert len(run(per_trigger=2)) == 2  # four files, two per micro-batch
    assert lake.rows() == [("AW-0", "US"), ("AW-1", "US"), ("AW-2", "US")]
    assert run() == []
    lake.land("source_erp/LOC_A101_3.csv", "CID,CNTRY\nAW-3,DE\n")
    assert [x.row_count for x in run()] == [1]
    assert len(lake.rows()) == 4
    assert bronze.read_log(spark, lake.bronze, "ingest_quarantine").count() == 1
    assert bronze.read_bronze(spark, lake.bronze, GEO.table).filter(F.col("_source_system") == "erp").count() == 4


def test_stream_of_names_never_reads_content(spark, lake):
    lake.land("source_erp/LOC_A101.csv", "CID,CNTRY\nAW-1,US\n")
    listed = headers.list_files(spark, GEO.path(lake.landing))
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,modificationTime:timestamp,length:bigint>" in plan
    assert new_files(spark, GEO.path(lake.landing), 1).isStreaming


def test_compaction_keeps_rows_and_batches(spark, lake):
    for n in range(4):
        lake.land(f"source_erp/LOC_A101_{n}.csv", f"CID,CNTRY\nAW-{n},US\n")
        lake.load(batch=f"b{n % 2}x{n}")
    target = scratch_path(spark, "compacted")
    assert bronze.compact_bronze(spark, lake.bronze, target) == [GEO.table]
    before = lake.rows(GEO, "CID", "_batch_id")
    lake.bronze = target
    assert lake.rows(GEO, "CID", "_batch_id") == before
