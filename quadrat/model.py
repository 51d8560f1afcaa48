"""Schemas and fixed values of the plot-data model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------------

OBSERVATIONS, SAMPLES = "observations", "samples"

QUERY_FACETS = {
    OBSERVATIONS: (
        "region_type",
        "region",
        "dataset",
        "site_id",
        "site_visit_id",
        "feature_type",
        "observed_property",
        "spatial",
        "project",
        "date_from",
        "date_to",
    ),
    SAMPLES: (
        "region_type",
        "region",
        "dataset",
        "site_id",
        "soil_subsite_id",
        "soil_depth_range",
        "speciesname",
        "material_sample_type",
        "used_procedure",
        "has_image",
        "spatial",
        "date_from",
        "date_to",
    ),
}

ATTRIBUTE_ENTITIES = ("dataset", "feature_type", "observation", "site", "site_visit")

# Region type -> its public identifier.
REGION_TYPES = {
    "subregions": "https://linked.data.gov.au/dataset/ibra7/subregions",
    "bioregions": "https://linked.data.gov.au/dataset/ibra7",
    "nrm-regions": "https://linked.data.gov.au/dataset/ausnrm2023",
    "states-and-territories": "https://linked.data.gov.au/dataset/asgsed3/STE",
    "local-government-areas": "https://linked.data.gov.au/dataset/asgsed3/LGA2023",
    "wwf-ecoregions": "https://linked.data.gov.au/dataset/wwf2011",
    "terrestrial-capad-regions": "https://linked.data.gov.au/dataset/auscapad2022",
}

PLANT_TISSUE = "Plant Tissue Sample"
PLANT_VOUCHER = "Plant Voucher Specimen"
SOIL_METAGENOMIC = "Soil Metagenomic Sample"
SOIL_PIT = "Soil Pit Sample"
SOIL_SUBSITE = "Soil Subsite Sample"
MATERIAL_SAMPLE_TYPES = (PLANT_TISSUE, PLANT_VOUCHER, SOIL_METAGENOMIC, SOIL_PIT, SOIL_SUBSITE)

# Fields of a sample document that never reach the user, besides those that start
# with DROPPED_SAMPLE_PREFIX.
DROPPED_SAMPLE_PREFIX = "region"
DROPPED_SAMPLE_FIELDS = (
    "geopoint",
    "tags",
    "dataset_attr_count",
    "direct_site_id",
    "geographic_information",
    "observed_property",
    "obsverved_property",
    "related_samples",
    "sample_attr_count",
    "sample_information",
    "site_attr_count",
    "sites_hierarchy",
    "site_hierarchy",
    "site_hirarchy",
    "site_visit_attr_count",
)
# Sample fields that hold vocabulary codes.
CODED_SAMPLE_FIELDS = (
    "used_procedure",
    "dataset",
    "feature_type",
    "site_visit_id",
    "material_sample_type",
)

IGSN_PREFIX = "10.60792/"
MISSING_TEXT = "N/A"

# Keys of an image cell that hold a URL, and the order images are listed in.
IMAGE_KEYS = (
    "original",
    "thumbnail_320",
    "thumbnail_640",
    "thumbnail_1280",
    "url",
    "href",
    "src",
    "download_url",
    "thumbnail",
)
IMAGE_ORDER = {"original": 0, "thumbnail_1280": 1, "thumbnail_640": 2, "thumbnail_320": 3}
IMAGE_ORDER_OTHER = 50
DEFAULT_IMAGE = "thumbnail_1280"

CLUSTER_PRECISION = 3
MAP_SITE_LIMIT = 250
# West, north, east, south edges of the map shown before anything is drawn.
MAP_WINDOW = (107.68366383276675, -9.83285528397626, 159.86061589572708, -44.49207177551449)

# --- schemas ----------------------------------------------------------------------

# One parsed GeoJSON feature. Attribute bags are free-form, hence VARIANT; an
# observation value may be a number or a text, hence STRING.
OBSERVATION_ITEM = T.StructType(
    [
        T.StructField("observableProperty", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("unit", T.StringType()),
        T.StructField("resultTime", T.StringType()),
        T.StructField("usedProcedure", T.StringType()),
        T.StructField("system", T.VariantType()),
    ]
)
FOI = T.StructType(
    [
        T.StructField("foi.id", T.StringType()),
        T.StructField("foi.type", T.StringType()),
        T.StructField("foi.link", T.StringType()),
        T.StructField("foi.scientificName", T.StringType()),
        T.StructField("foi.attributes", T.VariantType()),
        T.StructField(
            "foi.observations", T.MapType(T.StringType(), T.ArrayType(OBSERVATION_ITEM))
        ),
    ]
)
VISIT = T.StructType(
    [
        T.StructField("siteVisit.id", T.StringType()),
        T.StructField("siteVisit.name", T.StringType()),
        T.StructField("siteVisit.date", T.StringType()),
        T.StructField("siteVisit.link", T.StringType()),
        T.StructField("siteVisit.attributes", T.VariantType()),
        T.StructField("featureOfInterest", T.ArrayType(FOI)),
    ]
)
GEOMETRY = T.StructType(
    [T.StructField("type", T.StringType()), T.StructField("coordinates", T.VariantType())]
)
FEATURE = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField(
            "geometry",
            T.StructType(
                [
                    T.StructField("type", T.StringType()),
                    T.StructField("coordinates", T.VariantType()),
                    T.StructField("geometries", T.ArrayType(GEOMETRY)),
                ]
            ),
        ),
        T.StructField(
            "properties",
            T.StructType(
                [
                    T.StructField(
                        "dataset",
                        T.StructType(
                            [
                                T.StructField("dataset.title", T.StringType()),
                                T.StructField("dataset.link", T.StringType()),
                                T.StructField("dataset.attributes", T.VariantType()),
                            ]
                        ),
                    ),
                    T.StructField(
                        "site",
                        T.StructType(
                            [
                                T.StructField("site.name", T.StringType()),
                                T.StructField("site.link", T.StringType()),
                                T.StructField("site.attributes", T.VariantType()),
                            ]
                        ),
                    ),
                    T.StructField("siteVisit", T.ArrayType(VISIT)),
                ]
            ),
        ),
    ]
)
FEATURE_COLLECTION = T.StructType(
    [T.StructField("type", T.StringType()), T.StructField("features", T.ArrayType(FEATURE))]
)

SPEC_SCHEMA = "spec_id string, facet string, op string, value string"
VOCAB_SCHEMA = "facet string, uri string, label string"


@dataclass(frozen=True)
class SurveyTables:
    """The tables one engine works on. All but the fact tables are optional.

    ``codes`` says what the facet columns of the fact tables hold: the ``uri`` or the
    ``label`` of the vocabulary entry.
    """

    observation: DataFrame | None = None
    sample: DataFrame | None = None
    site: DataFrame | None = None
    site_region: DataFrame | None = None
    vocab: DataFrame | None = None
    site_attributes: DataFrame | None = None
    site_visit_attributes: DataFrame | None = None
    required_sample_dataset: str | None = None
    codes: str = "label"
