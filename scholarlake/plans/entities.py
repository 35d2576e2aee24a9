"""Output tables of the five entities.

Each table states what it reads (a shape) and how its columns follow from that.
Keys and column names are fixed by the format of the snapshots and of the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarlake.functions import strict_json as js
from scholarlake.functions.shape import JSON, NUMBER, SELDOM_TEXT, TEXT, TRUTH, WHOLE
from scholarlake.operators import records
from scholarlake.operators.dedup import first_per_id
from scholarlake.operators.records import RecordTable, parse_records, table_rows

Get = Callable[[str], Column]

# What stands for an absent required value.
NO_NAME = "Unknown"
NO_WORK_NAME = ""
NO_POSITION = "unknown"
NO_COUNT = 0

# Fixed value: the only kind of location that is put out.
PRIMARY = "primary"


def _name(value: Column, default: str = NO_NAME) -> Column:
    return F.coalesce(value, F.lit(default))


def _count(value: Column) -> Column:
    return F.coalesce(value, F.lit(NO_COUNT).cast("long"))


def _as_read(get: Get, *names: str) -> dict[str, Column]:
    return {name: get(name) for name in names}


# ---- authors


def _authors(get: Get) -> dict[str, Column]:
    return {
        "orcid": get("orcid"),
        "display_name": _name(get("display_name")),
        "display_name_alternatives": get("display_name_alternatives"),
        "works_count": _count(get("works_count")),
        "cited_by_count": _count(get("cited_by_count")),
        "last_known_institution": get("last_known_institution.id"),
        "works_api_url": get("works_api_url"),
        "updated_date": get("updated_date"),
    }


def _authors_ids(get: Get) -> dict[str, Column]:
    return _as_read(get, "openalex", "orcid", "scopus", "twitter", "wikipedia", "mag")


def _authors_counts_by_year(get: Get) -> dict[str, Column]:
    return {
        "year": js.wrapped(get("year")),
        "works_count": _count(get("works_count")),
        "cited_by_count": _count(get("cited_by_count")),
        "oa_works_count": _count(get("oa_works_count")),
    }


AUTHORS = (
    RecordTable(
        "authors",
        "id",
        {
            "orcid": TEXT,
            "display_name": TEXT,
            "display_name_alternatives": JSON,
            "works_count": WHOLE,
            "cited_by_count": WHOLE,
            "last_known_institution": {"id": TEXT},
            "works_api_url": TEXT,
            "updated_date": TEXT,
        },
        _authors,
    ),
    RecordTable(
        "authors_ids",
        "author_id",
        {
            "ids": {
                "openalex": TEXT,
                "orcid": TEXT,
                "scopus": TEXT,
                "twitter": TEXT,
                "wikipedia": TEXT,
                "mag": SELDOM_TEXT,  # a number in snapshots
            }
        },
        _authors_ids,
        child="ids",
    ),
    RecordTable(
        "authors_counts_by_year",
        "author_id",
        {
            "counts_by_year": [
                {
                    "year": WHOLE,
                    "works_count": WHOLE,
                    "cited_by_count": WHOLE,
                    "oa_works_count": WHOLE,
                }
            ]
        },
        _authors_counts_by_year,
        each="counts_by_year",
        required="year",
    ),
)


# ---- institutions


def _institutions(get: Get) -> dict[str, Column]:
    return {
        "ror": get("ror"),
        "display_name": _name(get("display_name")),
        **_as_read(get, "country_code", "type", "homepage_url", "image_url", "image_thumbnail_url"),
        **_as_read(get, "display_name_acronyms", "display_name_alternatives"),
        "works_count": _count(get("works_count")),
        "cited_by_count": _count(get("cited_by_count")),
        **_as_read(get, "works_api_url", "updated_date"),
    }


def _institutions_geo(get: Get) -> dict[str, Column]:
    return _as_read(
        get,
        "city",
        "geonames_city_id",
        "region",
        "country_code",
        "country",
        "latitude",
        "longitude",
    )


INSTITUTIONS = (
    RecordTable(
        "institutions",
        "id",
        {
            "ror": TEXT,
            "display_name": TEXT,
            "country_code": TEXT,
            "type": TEXT,
            "homepage_url": TEXT,
            "image_url": TEXT,
            "image_thumbnail_url": TEXT,
            "display_name_acronyms": JSON,
            "display_name_alternatives": JSON,
            "works_count": WHOLE,
            "cited_by_count": WHOLE,
            "works_api_url": TEXT,
            "updated_date": TEXT,
        },
        _institutions,
    ),
    RecordTable(
        "institutions_geo",
        "institution_id",
        {
            "geo": {
                "city": TEXT,
                "geonames_city_id": TEXT,
                "region": TEXT,
                "country_code": TEXT,
                "country": TEXT,
                "latitude": NUMBER,
                "longitude": NUMBER,
            }
        },
        _institutions_geo,
        child="geo",
    ),
)


# ---- publishers


def _publishers(get: Get) -> dict[str, Column]:
    return {
        "display_name": _name(get("display_name")),
        "alternate_titles": get("alternate_titles"),
        "country_codes": get("country_codes"),
        "hierarchy_level": js.wrapped(get("hierarchy_level")),
        "parent_publisher": get("parent_publisher"),
        "works_count": _count(get("works_count")),
        "cited_by_count": _count(get("cited_by_count")),
        "sources_api_url": get("sources_api_url"),
        "updated_date": get("updated_date"),
    }


PUBLISHERS = (
    RecordTable(
        "publishers",
        "id",
        {
            "display_name": TEXT,
            "alternate_titles": JSON,
            "country_codes": JSON,
            "hierarchy_level": WHOLE,
            "parent_publisher": TEXT,
            "works_count": WHOLE,
            "cited_by_count": WHOLE,
            "sources_api_url": TEXT,
            "updated_date": TEXT,
        },
        _publishers,
    ),
)


# ---- topics


def _topics(get: Get) -> dict[str, Column]:
    levels = {
        f"{level}_{part}": _name(get(f"{level}.{part}"))
        for level in ("subfield", "field", "domain")
        for part in ("id", "display_name")
    }
    return {
        "display_name": _name(get("display_name")),
        **levels,
        "description": get("description"),
        "keywords": js.joined(get("keywords")),
        "works_api_url": get("works_api_url"),
        "wikipedia_id": get("ids.wikipedia"),
        "works_count": _count(get("works_count")),
        "cited_by_count": _count(get("cited_by_count")),
        "updated_date": get("updated"),  # topics name this key differently
        "siblings": get("siblings"),
    }


TOPICS = (
    RecordTable(
        "topics",
        "id",
        {
            "display_name": TEXT,
            "subfield": {"id": TEXT, "display_name": TEXT},
            "field": {"id": TEXT, "display_name": TEXT},
            "domain": {"id": TEXT, "display_name": TEXT},
            "description": TEXT,
            "keywords": [TEXT],
            "works_api_url": TEXT,
            "ids": {"wikipedia": TEXT},
            "works_count": WHOLE,
            "cited_by_count": WHOLE,
            "updated": TEXT,
            "siblings": JSON,
        },
        _topics,
    ),
)


# ---- works


def _works(get: Get) -> dict[str, Column]:
    return {
        "doi": get("doi"),
        "title": get("title"),
        "display_name": _name(get("display_name"), NO_WORK_NAME),
        "publication_year": js.wrapped(get("publication_year")),
        "publication_date": get("publication_date"),
        "type": get("type"),
        "cited_by_count": _count(get("cited_by_count")),
        "is_retracted": F.coalesce(get("is_retracted"), F.lit(False)),
        "is_paratext": get("is_paratext"),
        "cited_by_api_url": get("cited_by_api_url"),
        "abstract_inverted_index": get("abstract_inverted_index"),
        "language": get("language"),
    }


def _works_locations(get: Get) -> dict[str, Column]:
    return {
        "source_id": get("source.id"),
        **_as_read(get, "landing_page_url", "pdf_url", "is_oa", "version", "license"),
        "location_type": F.lit(PRIMARY),
    }


def _works_authorships(get: Get) -> dict[str, Column]:
    """One row per author of a work; of several institutions the first counts."""
    return {
        "author_position": _name(get("author_position"), NO_POSITION),
        "author_id": get("author.id"),
        "institution_id": js.first(get("institutions.id")),
        "raw_affiliation_string": get("raw_affiliation_string"),
    }


def _works_topics(get: Get) -> dict[str, Column]:
    return {"topic_id": get("id"), "score": get("score")}


def _works_open_access(get: Get) -> dict[str, Column]:
    return _as_read(get, "is_oa", "oa_status", "oa_url", "any_repository_has_fulltext")


def _works_citations(get: Get) -> dict[str, Column]:
    """The edges of the citation graph."""
    return {"referenced_work_id": get("")}


WORKS = (
    RecordTable(
        "works",
        "id",
        {
            "doi": TEXT,
            "title": TEXT,
            "display_name": TEXT,
            "publication_year": WHOLE,
            "publication_date": TEXT,
            "type": TEXT,
            "cited_by_count": WHOLE,
            "is_retracted": TRUTH,
            "is_paratext": TRUTH,
            "cited_by_api_url": TEXT,
            "abstract_inverted_index": JSON,
            "language": TEXT,
        },
        _works,
    ),
    RecordTable(
        "works_locations",
        "work_id",
        {
            "primary_location": {
                "source": {"id": TEXT},
                "landing_page_url": TEXT,
                "pdf_url": TEXT,
                "is_oa": TRUTH,
                "version": TEXT,
                "license": TEXT,
            }
        },
        _works_locations,
        child="primary_location",
        required="source_id",
    ),
    RecordTable(
        "works_authorships",
        "work_id",
        {
            "authorships": [
                {
                    "author_position": TEXT,
                    "author": {"id": TEXT},
                    "institutions": [{"id": TEXT}],
                    "raw_affiliation_string": TEXT,
                }
            ]
        },
        _works_authorships,
        each="authorships",
        required="author_id",
    ),
    RecordTable(
        "works_topics",
        "work_id",
        {"topics": [{"id": TEXT, "score": NUMBER}]},
        _works_topics,
        each="topics",
        required="topic_id",
    ),
    RecordTable(
        "works_open_access",
        "work_id",
        {
            "open_access": {
                "is_oa": TRUTH,
                "oa_status": TEXT,
                "oa_url": TEXT,
                "any_repository_has_fulltext": TRUTH,
            }
        },
        _works_open_access,
        child="open_access",
    ),
    RecordTable(
        "works_citations",
        "work_id",
        {"referenced_works": [TEXT]},
        _works_citations,
        each="referenced_works",
        required="referenced_work_id",
    ),
)

# The first table of an entity has one row per record.
ENTITIES: dict[str, tuple[RecordTable, ...]] = {
    "authors": AUTHORS,
    "institutions": INSTITUTIONS,
    "publishers": PUBLISHERS,
    "topics": TOPICS,
    "works": WORKS,
}

TABLES: dict[str, RecordTable] = {t.name: t for tables in ENTITIES.values() for t in tables}


def entity_table(lines: DataFrame, name: str) -> DataFrame:
    """One table straight from lines (file_key, line_no, value): parse, dedup, cut out.

    Lazy, with one scan and one shuffle, and it parses only the keys of that
    table.  Use ``run`` for all tables of an entity.
    """
    table = TABLES[name]
    return table_rows(first_per_id(parse_records(lines, [table])), table)


def malformed_lines(lines: DataFrame, entity: str) -> DataFrame:
    """(file_key, line_no, reason): the lines that would fail a run of this entity."""
    return records.malformed_lines(lines, ENTITIES[entity])
