import json
import os

from layerloom.operators.sinks import replace_slices
from layerloom.sources import landing, schemas
from layerloom.streaming.ingest import document_stream, ingest_available

LOADED = "2024-02-01 00:00:00"


def document(folder, day, zone, prices):
    seconds = [1704067200 + 3600 * i for i in range(len(prices))]
    body = {"unix_seconds": seconds, "price": prices, "_meta": {"bidding_zone": zone, "fetch_date": day}}
    (folder / f"{zone}-{day}-{len(prices)}.json").write_text(json.dumps(body, indent=1))


def test_stream_equals_batch(spark, tmp_path, rows):
    folder, table = tmp_path / "landing", str(tmp_path / "table")
    folder.mkdir()

    def run():
        ingest_available(
            document_stream(spark, str(folder), schemas.PRICE_DOCUMENT, files_per_batch=1),
            lambda documents: landing.price_rows(documents, LOADED),
            table,
            partition_by=["date_key"],
            slice_keys=["date_key", "bidding_zone"],
            checkpoint=str(tmp_path / "checkpoint"),
        ).awaitTermination()
        return rows(spark.read.schema(schemas.RAW_SCHEMAS["energy_price_hourly"]).parquet(table))

    def batch():
        path = str(tmp_path / f"batch{len(list(folder.iterdir()))}")
        read = landing.read_documents(spark, str(folder), schemas.PRICE_DOCUMENT)
        replace_slices(spark, landing.price_rows(read, LOADED), path, ["date_key"], ["date_key", "bidding_zone"])
        return rows(spark.read.schema(schemas.RAW_SCHEMAS["energy_price_hourly"]).parquet(path))

    document(folder, "2024-01-01", "AT", [1.0, None])
    document(folder, "2024-01-01", "DE-LU", [2.0])
    assert run() == batch() and len(run()) == 3
    document(folder, "2024-01-02", "AT", [5.0])
    assert run() == batch() and len(run()) == 4


def test_a_corrected_document_replaces_its_slice(spark, tmp_path, rows):
    folder, table = tmp_path / "landing", str(tmp_path / "table")
    folder.mkdir()
    for prices in ([1.0], [7.0, 8.0]):
        document(folder, "2024-01-01", "AT", prices)
        document(folder, "2024-01-01", f"other{len(prices)}", [0.5])
        ingest_available(
            document_stream(spark, str(folder), schemas.PRICE_DOCUMENT),
            lambda documents: landing.price_rows(documents, LOADED),
            table,
            partition_by=["date_key"],
            slice_keys=["date_key", "bidding_zone"],
            checkpoint=str(tmp_path / "checkpoint"),
        ).awaitTermination()
    stored = spark.read.schema(schemas.RAW_SCHEMAS["energy_price_hourly"]).parquet(table)
    assert rows(stored, "bidding_zone", "price_eur_mwh") == [("AT", 7.0), ("AT", 8.0), ("other1", 0.5), ("other2", 0.5)]


def test_the_number_of_files_per_batch_does_not_show(spark, tmp_path, rows):
    """Two documents of one slice, the second one newer: its readings count, in one batch or in two."""
    folder = tmp_path / "landing"
    folder.mkdir()
    for number, prices in enumerate(([1.0, 2.0, 3.0], [7.0])):
        document(folder, "2024-01-01", "AT", prices)
        (written,) = [f for f in folder.iterdir() if not f.name.startswith("kept")]
        written.rename(folder / f"kept-{1 - number}-2024-01-01.json")
        os.utime(folder / f"kept-{1 - number}-2024-01-01.json", (1_700_000_000 + 100 * number,) * 2)
    found = []
    for files in (None, 1):
        table = str(tmp_path / f"table{files}")
        ingest_available(
            document_stream(spark, str(folder), schemas.PRICE_DOCUMENT, files_per_batch=files),
            lambda documents: landing.price_rows(documents, LOADED),
            table,
            partition_by=["date_key"],
            slice_keys=["date_key", "bidding_zone"],
            checkpoint=str(tmp_path / f"checkpoint{files}"),
        ).awaitTermination()
        stored = spark.read.schema(schemas.RAW_SCHEMAS["energy_price_hourly"]).parquet(table)
        found.append(rows(stored, "bidding_zone", "price_eur_mwh"))
    assert found == [[("AT", 7.0)]] * 2
