"""The user-facing object: select, discover, preview, retrieve, export, stream."""

from __future__ import annotations

import re
import warnings
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .errors import PlotDataError, UnfilteredReadError
from .functions import geometry
from .model import (
    ATTRIBUTE_ENTITIES,
    MAP_SITE_LIMIT,
    MISSING_TEXT,
    OBSERVATIONS,
    PLANT_VOUCHER,
    REGION_TYPES,
    SAMPLES,
    SPEC_SCHEMA,
    SurveyTables,
)
from .operators import align, discovery, images, lookup, paging, resolve, samples, spatial
from .operators.selection import LITERAL_FACETS, Selection, facet_column
from .session import configure
from .sinks import writers
from .sources import readers
from .streaming import jobs

SUMMARY_FACETS = {
    OBSERVATIONS: (
        "dataset",
        "site_id",
        "site_visit_id",
        "feature_type",
        "observed_property",
        "used_procedure",
    ),
    SAMPLES: ("site_id", "material_sample_type", "speciesname", "sample_name"),
}
# What `discover` can answer: question -> method.
ANSWERS: dict[str, Any] = {}


def _question(text: str) -> str:
    """A facet's name as words joined by underscores, however it is written."""
    return "_".join(re.findall("[a-z0-9]+", text.lower()))


def answers(*questions: str, asks: tuple[str, ...] = ()):
    """Let ``discover`` reach a method under these names, with what it asks for."""

    def register(method):
        method.asks = asks
        ANSWERS.update(dict.fromkeys(questions, method))
        return method

    return register


MODE_NAMES = {
    "observation": OBSERVATIONS,
    "observations": OBSERVATIONS,
    "obs": OBSERVATIONS,
    "sample": SAMPLES,
    "samples": SAMPLES,
}


class PlotData:
    """A selection over survey tables, with the questions one can ask of it.

    ``select`` and friends change this object and return it, so calls chain. A selection
    that fails, or that matches nothing, leaves the object as it was.
    """

    def __init__(
        self,
        tables: SurveyTables,
        mode: str = OBSERVATIONS,
        order: list[str] | None = None,
        depth_mode: str = "overlap",
    ):
        if mode not in MODE_NAMES:
            raise PlotDataError(f"Mode is one of: {', '.join(MODE_NAMES)}.")
        self.tables = tables
        self.mode = MODE_NAMES[mode]
        self.depth_mode = depth_mode
        facts = tables.observation if self.mode == OBSERVATIONS else tables.sample
        if facts is None:
            raise PlotDataError(f"There is no table for '{self.mode}' mode.")
        if self.mode == SAMPLES and tables.required_sample_dataset and "dataset" not in facts.columns:
            raise PlotDataError("The required dataset of samples cannot be checked without a dataset column.")
        self.facts: DataFrame = facts
        self.spark = configure(facts.sparkSession)
        self._seen: dict[tuple[str, str], Any] = {}
        self.order = order or (
            ["sample_id"]
            if self.mode == SAMPLES
            else [c for c, t in facts.dtypes if "map<" not in t and "variant" not in t]
        )
        self.clear()

    # --- selection ----------------------------------------------------------------

    def _required(self) -> dict[str, tuple[str, ...]]:
        name = self.tables.required_sample_dataset
        return {"dataset": (name,)} if self.mode == SAMPLES and name else {}

    def clear(self) -> "PlotData":
        """Drop all filters but the required dataset of 'samples' mode."""
        self._chosen, self._codes = self._resolve(Selection(self.mode, self._required()))
        return self

    def select(self, filters: Mapping[str, Any] | None = None, **more: Any) -> "PlotData":
        """Add filters. Values may be labels, identifiers, or close to a label."""
        wanted = self._chosen.add(self.spark, {**(filters or {}), **more})
        chosen, codes = self._resolve(wanted)
        if self._rows(chosen, codes).isEmpty():
            warnings.warn("Nothing matches; the former selection stays.", stacklevel=2)
            return self
        self._chosen, self._codes = chosen, codes
        return self

    def remove(self, filters: Mapping[str, Any] | None = None, **more: Any) -> "PlotData":
        """Remove whole facets (``None``) or single values of a facet."""
        chosen = self._chosen.drop({**(filters or {}), **more})
        self._chosen, self._codes = self._resolve(chosen)
        return self

    def from_date(self, date: str) -> "PlotData":
        return self.select(date_from=date)

    def to_date(self, date: str) -> "PlotData":
        return self.select(date_to=date)

    def get_filter(self, facet: str | None = None):
        return _listed(self._chosen.values, facet)

    def get_api_query_filters(self, facet: str | None = None):
        return _listed(self._codes, facet)

    def save_selection(self, path: str, spec_id: str) -> None:
        """Add this selection to a folder of saved selections."""
        rows = self._chosen.rows(spec_id)
        self.spark.createDataFrame(rows, SPEC_SCHEMA).write.mode("append").parquet(path)

    def load_selection(self, path: str, spec_id: str) -> "PlotData":
        saved = readers.read_selections(self.spark, path).where(F.col("spec_id") == spec_id)
        rows = [tuple(r) for r in saved.select("facet", "op", "value").collect()]
        if not rows:
            raise PlotDataError(f"No saved selection {spec_id!r}.")
        self._chosen, self._codes = self._resolve(Selection.from_rows(self.mode, rows))
        return self

    def _resolve(self, wanted: Selection) -> tuple[Selection, dict[str, Any]]:
        """Labels and codes of a selection, from one job over all facets."""
        labels, codes, asked = dict(wanted.values), dict(wanted.values), []
        for name, values in wanted.values.items():
            if name == "speciesname":
                labels[name] = codes[name] = self._species(values, wanted)
            elif name not in LITERAL_FACETS:
                asked += [(name, "dataset" if name == "project" else name, v) for v in values]
        if asked and self.tables.vocab is not None:
            self._look_up({(facet, str(v).strip()) for _, facet, v in asked})
            rows = {(name, v): self._seen[facet, str(v).strip()] for name, facet, v in asked}
            self._report(rows)
            for name in dict.fromkeys(n for n, _, _ in asked):
                got = [rows[name, v] for v in wanted.values[name]]
                labels[name] = tuple(dict.fromkeys(r["label"] for r in got))
                codes[name] = tuple(dict.fromkeys(r["uri"] for r in got))
        return Selection(self.mode, labels), codes

    def _look_up(self, values: set[tuple[str, str]]) -> None:
        """Resolve what the user typed (and this object has not resolved before)."""
        new = sorted(values - self._seen.keys())
        if new:
            asked = self.spark.createDataFrame(new, "facet string, value string")
            for r in resolve.resolve(asked, self.tables.vocab).collect():
                self._seen[r["facet"], r["value"]] = r
                if r["label"] is not None:  # a resolved label stands for itself
                    self._seen.setdefault((r["facet"], r["label"]), r)

    def _report(self, rows) -> None:
        bad = [f"{name} {v!r}" for (name, v), r in rows.items() if r["uri"] is None]
        if bad:
            raise PlotDataError(f"Nothing in the vocabulary is like: {'; '.join(bad)}")
        for (name, v), r in rows.items():
            if r["outcome"] == "fuzzy" and v != r["label"]:
                warnings.warn(f"Took {name} {v!r} as {r['label']!r}.", stacklevel=4)

    def _species(self, typed, wanted: Selection) -> tuple[str, ...]:
        """Names as they are spelt among the rows selected so far."""
        new = [v for v in typed if ("speciesname", v) not in self._seen]
        if new:
            so_far = {k: v for k, v in self._chosen.values.items() if k in wanted.values}
            so_far.pop("speciesname", None)
            rows = self._rows(Selection(self.mode, so_far), self._codes)
            matched = resolve.match_species(rows, "scientific_name", new).orderBy("position")
            found = matched.collect()  # one row per name the user typed
            bad = [r["value"] for r in found if r["speciesname"] is None]
            if bad:
                raise PlotDataError(f"No species here is like: {bad}")
            for v, r in zip(new, found):
                self._seen["speciesname", v] = self._seen["speciesname", r["speciesname"]] = r
        return tuple(dict.fromkeys(self._seen["speciesname", v]["speciesname"] for v in typed))

    def _rows(
        self, chosen: Selection, codes: Mapping[str, Any], facts: DataFrame | None = None
    ) -> DataFrame:
        by_label = self.tables.codes == "label"
        values = {k: v if by_label else codes.get(k, v) for k, v in chosen.values.items()}
        return Selection(self.mode, values).apply(facts or self.facts, self.tables, self.depth_mode)

    def selected(self) -> DataFrame:
        """The rows of the fact table under the selection."""
        return self._rows(self._chosen, self._codes)

    # --- counts and discovery -----------------------------------------------------

    def summary(self, approximate: bool = False) -> DataFrame:
        have = set(self.facts.columns)
        unique = {}
        for facet in SUMMARY_FACETS[self.mode]:
            try:
                unique[facet] = facet_column(facet, have)
            except PlotDataError:
                continue
        total = "observations" if self.mode == OBSERVATIONS else None
        return discovery.summary(self.selected(), unique, total, approximate)

    def discover(self, facet: str, region_type: str | None = None, include_region: bool = False) -> DataFrame:
        """Values of a facet, or one of the aggregates, by any of its names."""
        builder = ANSWERS.get(_question(facet))
        if builder is None:
            raise PlotDataError(f"There is nothing to discover under {facet!r}.")
        given = {"region_type": region_type, "include_region": include_region}
        return builder(self, *[given[name] for name in builder.asks])

    def _values(self, facet: str) -> DataFrame:
        column = facet_column(facet, set(self.facts.columns))
        return discovery.discover_values(
            self.selected(), column, self.tables.vocab, facet, self.tables.codes
        )

    def _only(self, mode: str, what: str) -> None:
        if self.mode != mode:
            raise PlotDataError(f"{what}: only for {mode}.")

    @answers("dataset", "datasource", "datasources")
    def get_datasources(self) -> DataFrame:
        name = self.tables.required_sample_dataset
        if self.mode == SAMPLES and name:
            uri = (self._codes.get("dataset") or (None,))[0]
            return self.spark.createDataFrame([(name, uri)], "key string, uri string")
        return self._values("dataset")

    @answers("site", "sites", "site_id", asks=("include_region",))
    def get_sites(self, include_region: bool = False) -> DataFrame:
        found = self._values("site_id")
        if not include_region:
            return found
        # of the known region types only the columns are fixed; absent ones stay NULL
        members = lookup.sites_of_samples(self.tables.site_region, self.selected())
        kinds = [r[0] for r in members.select("region_type").distinct().orderBy("region_type").collect()]
        wide = lookup.regions_wide(members, kinds).withColumn("_site", F.col("site_id").cast("string"))
        own = "key" if self.tables.codes == "label" else "uri"
        return found.join(wide.drop("site_id"), F.col(own) == F.col("_site"), "left").drop("_site")

    @answers("region_type", "region_types")
    def get_region_types(self) -> DataFrame:
        members = lookup.sites_of_samples(self.tables.site_region, self.selected())
        return discovery.discover_values(
            members, "region_type", self.tables.vocab, "region_type", self.tables.codes
        )

    @answers("region", "regions", asks=("region_type",))
    def get_regions(self, region_type: str | None) -> DataFrame:
        if not region_type:
            raise PlotDataError("Which regions? Give a region_type.")
        members = lookup.sites_of_samples(self.tables.site_region, self.selected())
        members = members.where(F.col("region_type") == self._region_type(region_type))
        return discovery.discover_values(members, "region", self.tables.vocab, "region", self.tables.codes)

    def _region_type(self, typed: str) -> str:
        """A region type of the vocabulary, else one of the known public ones."""
        asked = self.spark.createDataFrame([("region_type", typed)], "facet string, value string")
        row = resolve.resolve(asked, self.tables.vocab, resolve.REGION_TYPE_THRESHOLD).first()
        if row["uri"] is not None:
            return row["label" if self.tables.codes == "label" else "uri"]
        texts = self.spark.createDataFrame([(typed,)], "raw string")
        name = resolve.resolve_region_types(texts, "raw").first()["region_type"]
        if name is None:
            raise PlotDataError(
                f"No region type is like {typed!r}. Public ones: {', '.join(REGION_TYPES)}."
            )
        return name if self.tables.codes == "label" else REGION_TYPES[name]

    @answers("feature_type", "feature_types")
    def get_feature_types(self) -> DataFrame:
        return self._values("feature_type")

    @answers("observed_property", "observed_properties")
    def get_observed_properties(self) -> DataFrame:
        return self._values("observed_property")

    @answers("used_procedure", "used_procedures")
    def get_used_procedures(self) -> DataFrame:
        return self._values("used_procedure")

    @answers("material_sample_type", "material_sample_types")
    def get_material_sample_types(self) -> DataFrame:
        self._only(SAMPLES, "Material sample types")
        return self._values("material_sample_type")

    def discover_attributes(self, entity: str) -> DataFrame:
        """Attribute keys of an entity; its map column is ``<entity>_attrs`` or ``attrs``."""
        name = resolve.resolve_name(entity, ATTRIBUTE_ENTITIES)
        if name is None:
            raise PlotDataError(f"{entity!r} has no attributes.")
        column = next((c for c in (f"{name}_attrs", "attrs") if c in self.facts.columns), None)
        if column is None:
            raise PlotDataError(f"The table has no attribute map for {name!r}.")
        return discovery.discover_attributes(self.selected(), self.tables.vocab, column)

    @answers("dataset_attributes", "datasource_attributes")
    def get_datasources_attributes(self) -> DataFrame:
        return self.discover_attributes("dataset")

    @answers("site_attributes")
    def get_site_attributes(self) -> DataFrame:
        return self.discover_attributes("site")

    get_sites_attributes = get_site_attributes

    @answers("site_visit_attributes")
    def get_site_visit_attributes(self) -> DataFrame:
        return self.discover_attributes("site_visit")

    @answers("observation_attributes")
    def get_observation_attributes(self) -> DataFrame:
        self._only(OBSERVATIONS, "Observation attributes")
        return self.discover_attributes("observation")

    @answers("site_attributes_data", "site_attribute_data")
    def get_site_attributes_data(self) -> DataFrame:
        return readers.attribute_table(self.tables, "site", self.selected())

    @answers("site_visit_attributes_data", "site_visit_attribute_data")
    def get_site_visit_attributes_data(self) -> DataFrame:
        return readers.attribute_table(self.tables, "site_visit", self.selected())

    # --- sample aggregates --------------------------------------------------------

    def _sample_rows(self, aggregate: str, what: str) -> DataFrame:
        self._only(SAMPLES, what)
        discovery.require_sample_type(self._chosen.values.get("material_sample_type", ()), aggregate)
        return self.selected()

    @answers("sample_igsn")
    def get_sample_igsn(self) -> DataFrame:
        self._only(SAMPLES, "Sample IGSN lookup")
        return discovery.sample_igsn(self.selected())

    @answers("soil_depth_range")
    def get_soil_depth_range(self) -> DataFrame:
        return discovery.soil_depth_range(self._sample_rows("soil_depth_range", "Soil depth range"))

    @answers("soilpit")
    def get_soilpit(self) -> DataFrame:
        return discovery.soilpit_counts(self._sample_rows("soilpit", "Soil pit distribution"))

    @answers("speciesname")
    def get_speciesname(self) -> DataFrame:
        return discovery.species_counts(self._sample_rows("speciesname", "Species distribution"))

    def get_sample_images(self) -> DataFrame:
        """(sample_id, name, scientific_name, options, default) of samples with images."""
        self._only(SAMPLES, "Sample image listing")
        if not self._chosen.values.get("has_image"):
            raise PlotDataError("To list images, use select(has_image=True).")
        if PLANT_VOUCHER not in self._chosen.values.get("material_sample_type", ()):
            raise PlotDataError(f"Image listing needs material_sample_type {PLANT_VOUCHER!r}.")
        rows = self.selected().select(
            "sample_id",
            # a row without name and id is told apart by a hash of the row
            images.row_label(
                F.col("sample_name"), F.col("sample_id"), F.abs(F.xxhash64(*self.order))
            ).alias("name"),
            F.coalesce("scientific_name", F.lit(MISSING_TEXT)).alias("scientific_name"),
            images.image_options(F.col("sample_images").cast("string")).alias("options"),
        )
        rows = rows.where(F.size("options") > 0)
        return rows.withColumn("default", images.default_image(F.col("options")))

    # --- map ----------------------------------------------------------------------

    def clusters(self, shape=None) -> DataFrame:
        rows = self.selected()
        if shape is not None:
            rows = rows.where(geometry.in_bbox_or_shape(F.col("lon"), F.col("lat"), shape))
        return spatial.cluster_weights(spatial.clusters(rows))

    def map_layer(self, shape=None, window=None, limit: int = MAP_SITE_LIMIT) -> DataFrame:
        """Sites, or clusters from ``limit`` sites on, in a shape and a window if given."""
        return spatial.map_layer(self.selected(), window, limit, shape)

    def within_shapes(self, shapes: DataFrame) -> DataFrame:
        """The selected rows, each with the id of every polygon that holds its point.

        ``shapes`` has ``shape_id`` and ``ring`` (array of ``struct<x,y>``).
        """
        return spatial.points_in_polygons(self.selected(), shapes)

    def sites_in(self, shape) -> DataFrame:
        return spatial.sites_in_shape(self.selected(), shape)

    # --- retrieval ----------------------------------------------------------------

    def _shaped(self, rows: DataFrame, dformat: str) -> DataFrame:
        """Plain rows, rows with a ``geometry`` (WKT) column, or GeoJSON lines."""
        chosen = writers.FORMAT_NAMES.get(dformat.lower())
        if chosen is None or (self.mode == SAMPLES and dformat.lower() in ("geojson", "json")):
            raise PlotDataError(f"Format {dformat!r} is not for {self.mode}.")
        if dformat.lower() in ("geojson", "json"):
            return writers.geojson_lines(rows)
        if chosen == "geojson":
            lon, lat = ("lon", "lat") if "lon" in rows.columns else (align.LON, align.LAT)
            return align.add_point(rows, lon, lat)
        return rows

    def preview(self, dformat: str = "pandas") -> DataFrame:
        """Ten rows: of samples the first, of observations the first of two types."""
        if self.mode == SAMPLES:
            return self._shaped(self._clean(paging.preview(self.selected(), self.order)), dformat)
        if dformat.lower() in ("geojson", "json"):
            return self._shaped(self.page(1, paging.PREVIEW_LIMIT), dformat)
        rows = paging.preview_by_type(self.selected(), "feature_type", self.order)
        return self._shaped(rows, dformat)

    def page(self, page_number: int, page_size: int) -> DataFrame:
        return paging.page(self.selected(), self.order, page_number, page_size)

    def get_data(
        self, allow_full_download: bool = False, dformat: str = "pandas", fill: bool = False
    ) -> DataFrame:
        """All selected rows, always as a DataFrame.

        ``dformat``: plain columns ("pandas", "parquet"), with a WKT ``geometry`` column
        ("geopandas"), or one GeoJSON text per row ("geojson"). ``fill`` shows missing
        cells as "N/A", which makes all columns text.
        """
        if self.mode == SAMPLES:
            rows = samples.drop_empty_columns(self._clean(self.selected()))
        else:
            self._guard(allow_full_download)
            rows = self.selected()
        return self._shaped(align.fill_missing(rows) if fill else rows, dformat)

    def _clean(self, rows: DataFrame) -> DataFrame:
        """Samples as reading, preview and stream show them: of one type, fields cleaned."""
        kinds = self._chosen.values.get("material_sample_type", ())
        if len(kinds) != 1:
            raise PlotDataError(
                f"Select one material_sample_type to read samples ({len(kinds)} selected)."
            )
        return samples.clean_samples(rows, self.tables.vocab)

    def _guard(self, allow_full_download: bool) -> None:
        if not self._chosen.values and not allow_full_download:
            raise UnfilteredReadError(
                "Nothing is selected. Pass allow_full_download=True to read everything."
            )

    def export_data(
        self, path: str, dformat: str | None = None, allow_full_download: bool = False,
        partition_by: str | None = None,
    ) -> str:
        """Write the selected rows; the format follows the extension of ``path``."""
        writers.choose_format(path, dformat, self.mode)
        rows = self.get_data(allow_full_download)
        return writers.write_table(rows, path, dformat, self.mode, partition_by)

    def get_data_stream(
        self,
        stream: DataFrame,
        allow_full_download: bool = False,
        dformat: str = "parquet",
        **where: str,
    ) -> DataFrame:
        """Apply the selection to a stream of fact rows and land what passes.

        Observations land as one chunk per feature type, or as GeoJSON lines.
        """
        self._guard(allow_full_download)
        kept = self._rows(self._chosen, self._codes, stream)
        if self.mode == SAMPLES:
            kept = self._clean(kept)
        if self.mode == SAMPLES or dformat.lower() in ("geojson", "json"):
            return jobs.run_to_table(self._shaped(kept, dformat), "rows", **where)
        return jobs.chunks_by_type(kept, "feature_type", **where)

    def get_chunk_stream(
        self, stream: DataFrame, allow_full_download: bool = False, **where: str
    ) -> jobs.Chunks:
        """What passes of a stream of observations, a chunk per type with its own columns."""
        self._guard(allow_full_download)
        if self.mode == SAMPLES:
            raise PlotDataError("Chunks per feature type are for observations.")
        return jobs.land_chunks(self._rows(self._chosen, self._codes, stream), "feature_type", **where)


def _listed(values: Mapping[str, Any], facet: str | None):
    shown = {k: list(v) if isinstance(v, tuple) else v for k, v in values.items()}
    return shown if facet is None else shown.get(facet)
