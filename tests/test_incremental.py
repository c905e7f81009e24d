"""Two-batch end-to-end runs and hand rows."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from oracle_sql import SQL
from stagewise.operators.merge import AmbiguousMergeError
from stagewise.plans import fixture_queries as fq
from stagewise.plans.incremental import Layers, load_rejects, run_batch
from stagewise.sources.landing import read_landing
from stagewise.sources.tables import read_table

from .conftest import SF_SMALL

STAGES = ["introduction", "data_request", "data_validation", "facial_recognition", "signature",
          "data_confirmation"]


def _duck(sql, sf_dir):
    con = duckdb.connect()
    for t in ("customer", "nation", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    return [dict(zip(cols, r)) for r in res.fetchall()]


def _key(d):
    return tuple(str(d[k]) for k in sorted(d))


@pytest.fixture(scope="module")
def runs(spark):
    safe = fq.run_two_batches(spark, SF_SMALL, "null_safe", catalog_changes=False)
    strict = fq.run_two_batches(spark, SF_SMALL, "strict", catalog_changes=False)
    return safe, strict


def _pv(spark, layers):
    return read_table(spark, layers.table("gold", "pv_clients_stage"))


def test_incremental_equals_one_shot(spark):
    safe = fq.run_two_batches(spark, SF_SMALL, "null_safe")
    got = [r.asDict() for r in _pv(spark, safe).drop("ingestion_time", "update_date").collect()]
    want = _duck(SQL["incremental_two_batches"], SF_SMALL)
    assert len(got) == len(want)
    assert sorted(map(_key, got)) == sorted(map(_key, want))
    ids = [r["client_id"] for r in got]
    assert len(ids) == len(set(ids))                                  # one row per client


def test_strict_mode_with_changed_catalog_is_ambiguous(spark):
    # Insert-only gold rows keep old attributes, the 7-column pivot splits
    # a client whose email changed into two rows, and the pivot MERGE fails.
    with pytest.raises(AmbiguousMergeError):
        fq.run_two_batches(spark, SF_SMALL, "strict", catalog_changes=True)


def test_strict_mode_misses_new_stages(spark, runs):
    # With '<>' a client gaining a stage (NULL -> date) is never updated.
    safe, strict = runs
    s = _pv(spark, safe).select("client_id", *[F.col(c).alias("s_" + c) for c in STAGES])
    t = _pv(spark, strict).select("client_id", *STAGES)
    j = s.join(t, "client_id")
    gained = j.filter(" OR ".join(f"(s_{c} IS NOT NULL AND {c} IS NULL)" for c in STAGES)).count()
    assert gained > 0


def test_rerun_of_same_drop_changes_nothing(spark, runs):
    safe, _ = runs
    before = sorted(map(_key, [r.asDict() for r in _pv(spark, safe).collect()]))
    run_batch(spark, safe, "2024-02-15 00:00:00", "null_safe")
    after = sorted(map(_key, [r.asDict() for r in _pv(spark, safe).collect()]))
    assert before == after


def _csv(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


FUNNEL_CSV = """ID_cliente,App,stage,date,Proceso_completo
10001,ios,Introduccion,2024-01-01,1
10001,ios,Confirmacion de datos,2024-01-05,1
10002,android,Introduccion,2024/01/03,0
10003,ios,Otro,2024-01-05,0
123,ios,Firma,2024-01-06,0
10004,ios,Firma,not-a-date,x
,ios,Firma,2024-01-07,0
10005,ios,Firma,2024-01-08,0
10005,ios,Firma,2024-01-08,0
10006,ios,Confirmacion de datos,2024-01-09,0
10007,ios,Confirmacion de datos,2024-01-02,1
99999,ios,Firma,2024-01-10,0
"""
CLIENTS_CSV = """ID_cliente,Nombre,Correo,Edad,Estado
10001,Ana,a@x,17,Jalisco
10002,Bo,b@x,18,Jalisco
10003,Cy,c@x,,Colima
123,Di,d@x,51,Colima
10004,Ed,e@x,36,
10005,Fe,f@x,50,Colima
10006,Gi,g@x,26,Colima
10007,Hu,h@x,35,Colima
"""


def test_hand_rows_first_load(spark, tmp_path):
    base = str(tmp_path)
    layers = Layers(f"{base}/landing", f"{base}/bronze", f"{base}/silver", f"{base}/gold")
    _csv(f"{layers.landing}/usuarios_banco_con_funnel.csv", FUNNEL_CSV)
    _csv(f"{layers.landing}/clientes.csv", CLIENTS_CSV)
    run_batch(spark, layers, "2024-01-31 00:00:00")
    silver = {(r.client_id, r.stage): r for r in read_table(spark, layers.table("silver", "users_funnel")).collect()}
    assert silver[("10002", "Introduccion")].register_date.isoformat() == "2024-01-03"   # slash date parsed
    assert silver[("10004", "Firma")].register_date is None                               # reject -> NULL
    assert silver[("10004", "Firma")].complete_process is None
    cf = read_table(spark, layers.table("gold", "clients_funnel"))
    q = {r.client_id: r.quality_check for r in cf.collect()}
    assert q["123"] == "Not Passed" and q["10004"] == "Not Passed" and q["10001"] == "Passed"
    assert "99999" not in q                                                               # no catalog row
    pv = {r.client_id: r for r in read_table(spark, layers.table("gold", "pv_clients_stage")).collect()}
    assert pv["10003"].introduction is None                                               # unknown label only
    assert pv["10001"].data_confirmation.isoformat() == "2024-01-05"
    # A second load of a drop repeating one key twice is an ambiguous MERGE.
    with pytest.raises(AmbiguousMergeError):
        run_batch(spark, layers, "2024-02-28 00:00:00")


def test_run_failing_before_gold_is_completed_by_next_run(spark):
    from stagewise.plans.incremental import load_bronze, load_silver
    from stagewise.session import scratch_dir

    base = scratch_dir(spark, "crash")
    layers1 = Layers(f"{base}/landing1", f"{base}/bronze", f"{base}/silver", f"{base}/gold", buckets=4)
    fq._drop_batch(spark, SF_SMALL, 1, layers1.landing)
    run_batch(spark, layers1, fq.TS1)
    layers2 = Layers(f"{base}/landing2", f"{base}/bronze", f"{base}/silver", f"{base}/gold", buckets=4)
    fq._drop_batch(spark, SF_SMALL, 2, layers2.landing)
    load_bronze(spark, layers2, fq.TS2)
    load_silver(spark, layers2, fq.TS2)               # the run dies here, before gold
    run_batch(spark, layers2, "2024-02-02 00:00:00")  # next scheduled run, same drop, new stamp
    got = [r.asDict() for r in _pv(spark, layers2).drop("ingestion_time", "update_date").collect()]
    want = _duck(SQL["incremental_two_batches"], SF_SMALL)
    assert sorted(map(_key, got)) == sorted(map(_key, want))


def test_landing_stream_into_bucketed_bronze(spark):
    got = [r.asDict() for r in fq.landing_stream_two_drops(spark, SF_SMALL, buckets=4).collect()]
    want = _duck(SQL["create_or_merge"], SF_SMALL)
    assert sorted(map(_key, got)) == sorted(map(_key, want))


@pytest.mark.parametrize("second", [fq.TS1, "2023-01-01 00:00:00"])
def test_stamps_that_repeat_or_go_back_lose_nothing(spark, second):
    layers = fq.run_two_batches(spark, SF_SMALL, "null_safe", stamps=(fq.TS1, second))
    later = fq.run_two_batches(spark, SF_SMALL, "null_safe")
    got = [r.asDict() for r in _pv(spark, layers).drop("ingestion_time", "update_date").collect()]
    assert sorted(map(_key, got)) == sorted(map(_key, _duck(SQL["incremental_two_batches"], SF_SMALL)))
    for layer, name, stamp in (("bronze", "clientes", "fecha_ingesta"), ("silver", "users_funnel", "ingestion_date")):
        one, two = (sorted(map(str, read_table(spark, x.table(layer, name)).drop(stamp).collect())) for x in (layers, later))
        assert one == two


def test_duplicates_and_null_keys_under_a_policy(spark, tmp_path):
    base = str(tmp_path)
    layers = Layers(f"{base}/landing", f"{base}/bronze", f"{base}/silver", f"{base}/gold", buckets=4)
    _csv(f"{layers.landing}/usuarios_banco_con_funnel.csv", FUNNEL_CSV)
    _csv(f"{layers.landing}/clientes.csv", CLIENTS_CSV + "10008,Jo,j@x,35.0,Colima\n")
    tables = [("bronze", "usuarios_banco_con_funnel"), ("silver", "users_funnel"), ("gold", "pv_clients_stage")]
    sizes = []
    for _ in range(2):
        rejects = run_batch(spark, layers, "2024-01-31 00:00:00", dedupe=True, null_keys="drop")
        sizes.append([read_table(spark, layers.table(*t)).count() for t in tables])
    assert sizes[0] == sizes[1] and sizes[0][0] == 10        # 12 lines, one repeated, one without a key
    got = {(r.file, r.column): r.rejected for r in rejects.collect()}
    assert got["usuarios_banco_con_funnel", "register_date"] == 1 and got["usuarios_banco_con_funnel", "complete_process"] == 1
    ages = {r.client_id: r.age for r in read_table(spark, layers.table("silver", "catalog")).collect()}
    assert ages["10008"] == 35 and got["clientes", "age"] == 0
    assert got["usuarios_banco_con_funnel", "(line)"] == 0


def test_lines_with_too_few_or_too_many_fields_are_counted(spark, tmp_path):
    layers = Layers(*[str(tmp_path)] * 4)
    _csv(f"{tmp_path}/usuarios_banco_con_funnel.csv", FUNNEL_CSV + "10001,ios,Firma,2024-01-02,1,sixth\n10002,ios\n")
    _csv(f"{tmp_path}/clientes.csv", CLIENTS_CSV)
    got = {(r.file, r.column): (r.rows, r.rejected) for r in load_rejects(spark, layers).collect()}
    assert got["usuarios_banco_con_funnel", "(line)"] == (14, 2) and got["clientes", "(line)"] == (8, 0)


def test_a_run_reads_each_landing_file_once(spark, tmp_path, monkeypatch):
    """The files are gone once they are staged, and the run is none the worse for it."""
    import shutil

    from stagewise.plans import incremental

    layers = Layers(f"{tmp_path}/landing", f"{tmp_path}/bronze", f"{tmp_path}/silver", f"{tmp_path}/gold", buckets=4)
    _csv(f"{layers.landing}/usuarios_banco_con_funnel.csv", FUNNEL_CSV)
    _csv(f"{layers.landing}/clientes.csv", CLIENTS_CSV)
    reads, staged = [], incremental.load_bronze
    monkeypatch.setattr(incremental, "read_landing", lambda *a, **k: reads.append(a[2]) or read_landing(*a, **k))

    def bronze(*a, **k):
        shutil.move(layers.landing, f"{tmp_path}/elsewhere")
        return staged(*a, **k)

    monkeypatch.setattr(incremental, "load_bronze", bronze)
    rejects = {(r.file, r.column): r.rejected for r in run_batch(spark, layers, "2024-01-31 00:00:00").collect()}
    assert sorted(reads) == ["clientes", "usuarios_banco_con_funnel"]
    assert rejects["usuarios_banco_con_funnel", "register_date"] == 1
    assert _pv(spark, layers).count() == 8
    bronze_ids = sorted(str(r.ID_cliente) for r in read_table(spark, layers.table("bronze", "usuarios_banco_con_funnel")).collect())
    silver_ids = sorted(str(r.client_id) for r in read_table(spark, layers.table("silver", "users_funnel")).collect())
    assert bronze_ids == silver_ids and len(bronze_ids) == 12


def test_dedupe_keeps_rows_without_a_key(spark, tmp_path):
    layers = Layers(f"{tmp_path}/landing", f"{tmp_path}/bronze", f"{tmp_path}/silver", f"{tmp_path}/gold", buckets=4)
    _csv(f"{layers.landing}/usuarios_banco_con_funnel.csv", FUNNEL_CSV + ",android,Firma,2024-01-08,0\n")
    _csv(f"{layers.landing}/clientes.csv", CLIENTS_CSV)
    run_batch(spark, layers, "2024-01-31 00:00:00", dedupe=True)
    rows = read_table(spark, layers.table("bronze", "usuarios_banco_con_funnel")).collect()
    assert sum(r.ID_cliente is None for r in rows) == 2 and len(rows) == 12


def test_running_a_drop_again_repairs_buckets_that_were_left_old(spark):
    """Replacing buckets isn't atomic: a run that died half-way left old buckets beside new ones."""
    import shutil

    base = fq.scratch_dir(spark, "half")
    for batch, ts in ((1, fq.TS1), (2, fq.TS2)):
        layers = Layers(f"{base}/landing{batch}", f"{base}/bronze", f"{base}/silver", f"{base}/gold", buckets=4)
        fq._drop_batch(spark, SF_SMALL, batch, layers.landing)
        if batch == 2:
            shutil.copytree(base.removeprefix("file:"), f"{base.removeprefix('file:')}-before")
        run_batch(spark, layers, ts)
    names = [("bronze", "clientes"), ("silver", "users_funnel"), ("silver", "catalog"), ("gold", "clients_funnel"), ("gold", "pv_clients_stage")]
    want = {n: sorted(map(str, read_table(spark, layers.table(*n)).drop("update_date", "ingestion_date").collect())) for n in names}
    for layer, name in names:  # every second bucket is as it was
        for k in (0, 2):
            now = f"{layers.table(layer, name)}/sw_bucket={k}".removeprefix("file:")
            old = now.replace(base.removeprefix("file:"), base.removeprefix("file:") + "-before")
            shutil.rmtree(now)
            shutil.copytree(old, now)
    spark.catalog.clearCache()
    run_batch(spark, layers, fq.TS2)
    for n in names:
        got = sorted(map(str, read_table(spark, layers.table(*n)).drop("update_date", "ingestion_date").collect()))
        assert got == want[n], n
