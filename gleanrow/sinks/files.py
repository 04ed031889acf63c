"""File sinks. Rows are sorted and formatted by Spark; a single file is streamed partition by partition."""

from __future__ import annotations

import csv
import json
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.report import map_projection, marker_rows

OPERATOR_COLUMNS = ("operator_key", "operator_name", "registration_number", "trade_register", "platforms", "listing_count",
    "professional_listings")
REVIEW_COLUMNS = ("group_id", "id", "platform", "name", "latitude", "longitude", "latitude_best", "longitude_best", "registration", "phone",
    "thumbnail_url")
# Marker colours by business type and platform, else by platform.
TYPE_COLOURS = {("Professional", "booking"): "darkblue", ("Professional", "airbnb"): "darkred"}
PLATFORM_COLOURS = {"booking": "blue", "airbnb": "red"}


def write_csv(df: DataFrame, path: str, columns=None) -> str:
    """One UTF-8 file with a byte-order mark and a header; rows come through in df's order."""
    names = list(columns or df.columns)
    with open(path, "w", newline="", encoding="utf-8-sig") as f:
        out = csv.writer(f)
        out.writerow(names)
        out.writerows(df.select(*names).toLocalIterator(prefetchPartitions=True))
    return path


def export_csv(listings: DataFrame, path: str) -> str:
    return write_csv(map_projection(listings).orderBy("platform", "name", "id"), path)


def geojson_features(listings: DataFrame) -> DataFrame:
    """feature: a GeoJSON feature per row with coordinates; nulls are kept, raw coordinates are not properties."""
    rows = map_projection(listings.where("latitude is not null and longitude is not null"))
    if "is_superhost" in rows.columns:
        rows = rows.withColumn("is_superhost", F.col("is_superhost").cast("boolean"))
    properties = F.struct(*(c for c in rows.columns if c not in ("latitude", "longitude")))
    geometry = F.struct(F.lit("Point").alias("type"), F.array("map_longitude", "map_latitude").alias("coordinates"))
    feature = F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), properties.alias("properties")),
        {"ignoreNullFields": "false"})
    return rows.select("platform", "name", "id", feature.alias("feature")).orderBy("platform", "name", "id").select("feature")


def export_geojson(listings: DataFrame, path: str) -> str:
    with open(path, "w", encoding="utf-8") as f:
        f.write('{"type": "FeatureCollection", "features": [')
        for i, r in enumerate(geojson_features(listings).toLocalIterator(prefetchPartitions=True)):
            f.write((",\n" if i else "\n") + r["feature"])
        f.write("\n]}\n")
    return path


def export_operators(summary: DataFrame, path: str) -> str:
    return write_csv(summary.orderBy(F.desc("listing_count"), "operator_key"), path, OPERATOR_COLUMNS)


def _collections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of one FeatureCollection from a task's features; a comma stands before all but the first."""
    line = lambda some: pa.RecordBatch.from_arrays([pa.array(some, pa.string())], ["value"])
    yield line(['{"type": "FeatureCollection", "features": ['])
    first = True
    for batch in batches:
        if batch.num_rows:
            features = batch.column(0).to_pylist()
            yield line([features[0] if first else "," + features[0], *("," + f for f in features[1:])])
            first = False
    yield line(["]}"])


def save_geojson(listings: DataFrame, path: str) -> None:
    """The GeoJSON export as a folder on any file system: each part file is a FeatureCollection of its own, sorted across files.

    Tasks frame and write their parts and Spark commits them, so nothing passes the driver and a lost task leaves no torn file.
    """
    geojson_features(listings).mapInArrow(_collections, "value string").write.text(path)


def save_csv(listings: DataFrame, path: str) -> None:
    """The listing export as a folder of sorted part files on any file system, each with a byte-order mark and a header."""
    _save(map_projection(listings), ["platform", "name", "id"], path)


def save_operators(summary: DataFrame, path: str) -> None:
    """The operator export as a folder of sorted part files."""
    _save(summary.select(*OPERATOR_COLUMNS), [F.desc("listing_count"), "operator_key"], path)


def _save(df: DataFrame, order: list, path: str) -> None:
    marked = df.orderBy(*order).withColumnRenamed(df.columns[0], "\ufeff" + df.columns[0])
    marked.write.option("header", True).option("escape", '"').csv(path)


def metrics_text(metrics: DataFrame) -> DataFrame:
    """document: the JSON text of a one-row DataFrame, nulls kept."""
    return metrics.select(F.to_json(F.struct(*metrics.columns), {"ignoreNullFields": "false"}).alias("document"))


def export_metrics(metrics: DataFrame, path: str) -> str:
    """A one-row DataFrame as a JSON document."""
    document = json.loads(metrics_text(metrics).first()["document"])
    Path(path).write_text(json.dumps(document, ensure_ascii=False, indent=2), encoding="utf-8")
    return path


def review_sample(listings: DataFrame, sample: int = 200) -> DataFrame:
    """The first 2 * sample rows of grouped listings by group and id; the last group may be cut."""
    have = [F.col(c) if c in listings.columns else F.lit(None).cast("string").alias(c) for c in REVIEW_COLUMNS]
    return listings.where("group_id is not null").select(*have).orderBy("group_id", "id").limit(2 * sample)


def export_review(listings: DataFrame, path: str, sample: int = 200) -> str:
    return write_csv(review_sample(listings, sample).orderBy("group_id", "id"), path, REVIEW_COLUMNS)


def _popup_row(label: str, value) -> F.Column:
    cell = F.concat(F.lit(f"<tr><td>{label}</td><td>"), T.html_escape(value.cast("string")), F.lit("</td></tr>"))
    return F.when(value.isNotNull() & (value.cast("string") != ""), cell).otherwise("")


def popup_html(listings: DataFrame):
    """A column: a picture, the escaped table of all fields that are known, and a link to the page."""
    kinds = dict(listings.dtypes)
    has = lambda c: F.col(c) if c in kinds else F.lit(None).cast("string")
    # ties go to the even digit, as C prints them; Java's format would round them up
    number = lambda c, digits: F.format_string(f"%.{digits}f", F.bround(has(c).cast("double"), digits))

    def known(test: str, *parts) -> F.Column:
        return F.when(has(test).isNotNull(), F.concat(*parts))

    stars = known("star_rating", number("star_rating", 0), F.lit(" stars"))
    best = lambda c: "map_" + c if "map_" + c in kinds else c
    rows = [
        ("Platform", has("platform")), ("Type", has("property_type")), ("Stars", stars),
        ("Price", known("price_per_night", number("price_per_night", 0), F.lit(" "), F.coalesce(has("currency"), F.lit("")))),
        ("Rating", known("review_score", number("review_score", 1), F.lit(" ("),
        F.format_number(F.coalesce(has("review_count"), F.lit(0)).cast("long"), 0), F.lit(")"))),
        ("Bedrooms", has("bedrooms")), ("Beds", has("beds")), ("Bathrooms", known("bathrooms", number("bathrooms", 1))),
        ("Guests", has("max_guests")),
        ("Business", has("business_name")), ("Kind", has("business_type")), ("Registration", has("registration")),
        ("Register", has("trade_register")), ("VAT", has("vat")),
        ("Email", has("email")), ("Phone", has("phone")), ("Address", has("address")), ("Country", has("country")),
        ("Host", has("host_name")), ("Superhost", F.when(has("is_superhost").cast("boolean"), "yes")),
        ("Response", has("host_response_rate")), ("Answers", has("host_response_time")), ("Since", has("host_join_date")),
        ("Coordinates", known(best("latitude"), number(best("latitude"), 5), F.lit(", "), number(best("longitude"), 5))),
        ("Accuracy", known("est_accuracy_m", number("est_accuracy_m", 1), F.lit(" m"))),
        ("Confidence", known("position_confidence", number("position_confidence", 2))),
        ("Radius", known("radius_m", number("radius_m", 0), F.lit(" m"))), ("Position", has("map_precision")),
        ("Platform says", has("platform_precision")), ("Source", has("map_source")),
    ]
    picture = F.when(F.coalesce(has("thumbnail_url"), F.lit("")) != "",
        F.concat(F.lit('<img src="'), T.html_escape(has("thumbnail_url")), F.lit('">'))).otherwise("")
    page = T.html_escape(has("url"))
    link = F.when(F.coalesce(has("url"), F.lit("")) != "", F.concat(F.lit('<tr><td>Page</td><td><a href="'), page, F.lit('">'), page,
        F.lit("</a></td></tr>"))).otherwise("")
    return F.concat(F.lit("<b>"), T.html_escape(has("name")), F.lit("</b>"), picture, F.lit("<table>"),
        *(_popup_row(label, v) for label, v in rows), link, F.lit("</table>"))


def map_markers(listings: DataFrame) -> DataFrame:
    """latitude, longitude, platform, colour, tooltip, popup of every row that a map can show."""
    rows = map_projection(marker_rows(listings))
    colour = F.when(F.col("platform") == "booking", PLATFORM_COLOURS["booking"]).when(F.col("platform") == "airbnb",
        PLATFORM_COLOURS["airbnb"]).otherwise("gray")
    for (kind, platform), name in TYPE_COLOURS.items():
        colour = F.when((F.col("business_type") == kind) & (F.col("platform") == platform), name).otherwise(colour)
    tooltip = F.concat("name", F.lit(" · "), "platform")
    return rows.select(F.col("map_latitude").alias("latitude"), F.col("map_longitude").alias("longitude"), "platform",
        colour.alias("colour"), tooltip.alias("tooltip"), popup_html(rows).alias("popup"))


def export_map(listings: DataFrame, path: str) -> str:
    """A self-contained page: a legend with counts and one list item per marker, with its data attributes."""
    markers = map_markers(listings)
    n = {r["platform"]: r["count"] for r in markers.groupBy("platform").count().collect()}
    item = F.concat(
        F.format_string("<li data-lat='%s' data-lng='%s' data-colour='", F.col("latitude").cast("string"),
        F.col("longitude").cast("string")), F.col("colour"), F.lit("' title='"), T.html_escape(F.col("tooltip")), F.lit("'>"),
        F.col("popup"), F.lit("</li>\n")
    )
    with open(path, "w", encoding="utf-8") as f:
        f.write(f"<!DOCTYPE html><html><head><meta charset='utf-8'></head><body><div id='legend'>A ({n.get('booking', 0):,}) B ({n.get('airbnb', 0):,}) Total: {sum(n.values()):,}</div><ul>\n")
        for r in markers.select(item.alias("item")).toLocalIterator(prefetchPartitions=True):
            f.write(r["item"])
        f.write("</ul></body></html>\n")
    return path


def dump_raw(payloads: DataFrame, path: str) -> None:
    """Landed payloads (cell_id, payload) as JSON text, a folder per cell."""
    payloads.select("cell_id", F.col("payload").alias("value")).write.partitionBy("cell_id").mode("append").text(path)


def replace_ledger(observations: DataFrame, path: str) -> None:
    """The observation ledger is rebuilt as a whole."""
    observations.write.mode("overwrite").parquet(path)
