import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from layerloom.sources import delimited, landing, schemas

LOADED = "2024-02-01 03:04:05"


def write_json(folder, name, document):
    (folder / name).write_text(json.dumps(document, indent=2, ensure_ascii=False), encoding="utf-8")


def weather(day, hourly, key="berlin"):
    meta = {"location_key": key, "fetch_date": day, "source": "open-meteo"}
    return {"latitude": 52.5, "longitude": 13.4, "hourly": hourly, "_meta": meta}


def test_weather_documents(spark, tmp_path, rows):
    full = {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m": [1.5, None], "weathercode": [3, 61]}
    write_json(tmp_path, "2024-01-01.json", weather("2024-01-01", full | {"precipitation": [0.5]}))
    write_json(tmp_path, "2024-01-02.json", weather("2024-01-02", {"time": []}))
    write_json(tmp_path, "2024-01-03.json", weather("2024-01-03", {"time": ["2024-01-03T00:00"], "precipitation": [1, 2, 3]}))
    (tmp_path / "notes.txt").write_text("not a document")
    documents = landing.read_documents(spark, str(tmp_path), schemas.WEATHER_DOCUMENT)
    raw = landing.weather_rows(documents, LOADED)
    assert raw.schema.simpleString() == schemas.RAW_SCHEMAS["weather_hourly"].simpleString()
    found = rows(raw, "timestamp", "date_key", "hour", "temperature_2m", "precipitation", "weathercode", "apparent_temperature")
    at = lambda day, hour: (dt.datetime(2024, 1, day, hour), dt.date(2024, 1, day), hour)
    assert found == [
        (*at(1, 0), 1.5, 0.5, 3, None),
        (*at(1, 1), None, None, 61, None),
        (*at(3, 0), None, 1.0, None, None),
    ]
    days = raw.select(landing.day_in_file_name(F.col("_source_file")).alias("d"), "_loaded_at").distinct()
    assert rows(days) == [
        (dt.date(2024, 1, 1), dt.datetime(2024, 2, 1, 3, 4, 5)),
        (dt.date(2024, 1, 3), dt.datetime(2024, 2, 1, 3, 4, 5)),
    ]


def test_price_documents(spark, tmp_path, rows):
    def document(zone, seconds, prices):
        return {"unix_seconds": seconds, "price": prices, "_meta": {"bidding_zone": zone, "fetch_date": "2018-10-01"}}

    write_json(tmp_path, "a.json", document("DE-LU", [1538344800, 1538348400, 1538352000], [-4.5, None]))
    write_json(tmp_path, "b.json", document("AT", [1538344800], [10]))
    write_json(tmp_path, "c.json", {"_meta": {"bidding_zone": "FR", "fetch_date": "2018-10-01"}})
    raw = landing.price_rows(landing.read_documents(spark, str(tmp_path), schemas.PRICE_DOCUMENT), LOADED)
    assert raw.schema.simpleString() == schemas.RAW_SCHEMAS["energy_price_hourly"].simpleString()
    day, utc = dt.date(2018, 10, 1), dt.datetime(2018, 9, 30, 22)
    assert rows(raw, "bidding_zone", "timestamp", "date_key", "hour", "price_eur_mwh") == [
        ("AT", utc, day, 22, 10.0),
        ("DE-LU", utc, day, 22, -4.5),
        ("DE-LU", utc + dt.timedelta(hours=1), day, 23, None),
        ("DE-LU", utc + dt.timedelta(hours=2), day, 0, None),
    ]


def test_artist_documents(spark, tmp_path, rows):
    artists = [
        {"artist_id": "1", "artist_name": "Ö", "genres": "pop, rock", "popularity": 0, "followers": 5},
        {"artist_id": "2", "artist_name": "B", "popularity": None, "followers": None},
    ]
    write_json(tmp_path, "2024-01-01.json", {"artists": artists, "_meta": {"snapshot_date": "2024-01-01"}})
    write_json(tmp_path, "2024-01-08.json", {"artists": [], "_meta": {"snapshot_date": "2024-01-08"}})
    raw = landing.artist_rows(landing.read_documents(spark, str(tmp_path), schemas.ARTIST_DOCUMENT), LOADED)
    assert raw.schema.simpleString() == schemas.RAW_SCHEMAS["spotify_artist_snapshots"].simpleString()
    day = dt.date(2024, 1, 1)
    assert rows(raw, "artist_id", "artist_name", "genres", "popularity", "followers", "snapshot_date") == [
        ("1", "Ö", "pop, rock", 0, 5, day),
        ("2", "B", "", None, None, day),
    ]


def test_query_documents(spark, tmp_path, rows):
    schema = schemas.query_document(schemas.struct(owner=schemas.TEXT, num_rows=schemas.LONG))
    data = [{"owner": "A", "num_rows": 0}, {"owner": "B", "num_rows": None}]
    write_json(tmp_path, "1.json", {"query_date": "2024-01-01", "source": "s", "row_count": 2, "data": data})
    write_json(tmp_path, "2.json", {"query_date": "2024-01-02", "source": "s", "row_count": 3, "data": data[:1]})
    write_json(tmp_path, "3.json", {"query_date": "2024-01-03", "source": "s", "row_count": 0, "data": []})
    documents = landing.read_documents(spark, str(tmp_path), schema)
    assert rows(landing.query_rows(documents)) == [
        (dt.date(2024, 1, 1), "A", 0),
        (dt.date(2024, 1, 1), "B", None),
        (dt.date(2024, 1, 2), "A", 0),
    ]
    assert rows(landing.miscounted_documents(documents), "query_date", "row_count", "rows_found") == [("2024-01-02", 3, 1)]


def test_broken_document_fails_the_load(spark, tmp_path):
    (tmp_path / "x.json").write_text("{")
    documents = landing.read_documents(spark, str(tmp_path), schemas.PRICE_DOCUMENT)
    with pytest.raises(Exception, match="(?i)malformed"):
        landing.price_rows(documents, LOADED).collect()


CHARTS = """title,rank,date,artist,url,region,chart,trend,streams
"Say ""Hi"", now",1,2021-01-01,Zoë,u1,Germany,top200,SAME_POSITION,100
B,2,2021-01-01,X,u2,Argentina,top200,MOVE_UP,NULL
C,3,2021-01-02,"A, B",u3,Global,viral50,NEW_ENTRY,
"""


def test_bulk_charts(spark, tmp_path, rows):
    (tmp_path / "charts.csv").write_text(CHARTS, encoding="utf-8")
    raw = delimited.chart_rows(
        delimited.read_text_columns(spark, str(tmp_path / "charts.csv"), columns=list(delimited.CHART_COLUMNS)), LOADED
    )
    assert raw.schema.simpleString() == schemas.RAW_SCHEMAS["spotify_charts"].simpleString()
    assert rows(raw, "track_name", "position", "artist_name", "region", "streams") == [
        ("B", 2, "X", "Argentina", None),
        ("C", 3, "A, B", "Global", None),
        ('Say "Hi", now', 1, "Zoë", "Germany", 100),
    ]


def test_bulk_load_fails_on_a_bad_number(spark, tmp_path):
    (tmp_path / "charts.csv").write_text(CHARTS.replace(",100\n", ",many\n"), encoding="utf-8")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        delimited.chart_rows(delimited.read_text_columns(spark, str(tmp_path / "charts.csv")), LOADED).collect()


def test_filtered_charts(spark, tmp_path, rows):
    text = CHARTS.replace(",100\n", ",3.9\n") + "D,x,,Q,u4,Germany,top200,SAME,5\n" + "E,x,2021-01-03,Q,u5,Austria,top200,SAME,y\n"
    (tmp_path / "charts.csv").write_bytes(text.encode() + b"F\xff,4,2021-01-04,Q,u6,Global,top200,SAME,7\n")
    found = delimited.chart_rows_of_regions(delimited.read_text_columns(spark, str(tmp_path / "charts.csv")), LOADED)
    assert rows(found, "track_name", "position", "region", "streams") == [
        ("C", 3, "Global", None),
        ("E", None, "Austria", None),
        ("F�", 4, "Global", 7),
        ('Say "Hi", now', 1, "Germany", 3),
    ]


def test_tracks(spark, tmp_path, rows):
    header = ",track_id,artists,album_name,track_name,popularity,duration_ms,explicit,danceability,energy,key,loudness,mode,speechiness,acousticness,instrumentalness,liveness,valence,tempo,time_signature,track_genre"
    line = "0,T1,A;B,,N,3.7,x,False,0.5,.1,1,-5.5,0,0,0,1e-3,0,0,120,4,pop"
    (tmp_path / "tracks.csv").write_text(f"{header}\n{line}\n", encoding="utf-8")
    raw = delimited.track_rows(delimited.read_text_columns(spark, str(tmp_path / "tracks.csv")), LOADED)
    assert raw.schema.simpleString() == schemas.RAW_SCHEMAS["spotify_tracks"].simpleString()
    columns = ["track_id", "artist_name", "album_name", "popularity", "duration_ms", "explicit", "musical_key", "musical_mode", "instrumentalness"]
    assert rows(raw, *columns) == [("T1", "A;B", None, 3, None, False, 1, 0, 0.001)]
