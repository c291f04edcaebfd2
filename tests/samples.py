"""Small catalogue rows for the tests, made up for them."""

import json
import os

from ledgerline.sources.spec import schema_from_spec

HERE = os.path.dirname(os.path.abspath(__file__))


def spec():
    with open(os.path.join(HERE, "fixtures", "catalogue_spec.json")) as f:
        return json.load(f)


def media_spec():
    return schema_from_spec(spec(), "media")


def _hash(n: int) -> str:
    return f"{n:040x}"


# Three titles: a film someone accepted, a film nobody has judged and whose money
# columns are empty, and an accepted episode.
MEDIA_SAMPLES = [
    {"hash": _hash(701), "media_type": "movie", "media_title": "Paper Lighthouse", "release_year": 1998,
     "pipeline_status": "complete", "error_status": False, "rejection_status": "accepted",
     "original_title": "paper lighthouse 1998 remaster", "rss_source": "yts.mx", "imdb_id": "tt7000011",
     "tmdb_id": 7011, "budget": 410000, "revenue": 263000, "runtime": 131,
     "origin_country": ["IS", "NO"], "genre": ["Adventure"], "tmdb_rating": 6.4,
     "rt_score": 61, "imdb_rating": 6.6, "imdb_votes": 871},
    {"hash": _hash(702), "media_type": "movie", "media_title": "Seven Quiet Kettles", "release_year": 2011,
     "pipeline_status": "ingested", "error_status": False, "rejection_status": "unfiltered",
     "original_title": "seven quiet kettles", "rss_source": "episodefeed.com", "imdb_id": "tt7000022",
     "tmdb_id": 7022, "budget": None, "revenue": None, "runtime": 77,
     "origin_country": ["PT"], "genre": ["Western"], "tmdb_rating": 4.9,
     "rt_score": 30, "imdb_rating": 5.1, "imdb_votes": 46},
    {"hash": _hash(703), "media_type": "tv_show", "media_title": "Harbour Clerks", "season": 4, "episode": 9,
     "release_year": 2006, "pipeline_status": "parsed", "error_status": False,
     "rejection_status": "accepted", "original_title": "harbour clerks 4x09", "rss_source": "episodefeed.com",
     "imdb_id": "tt7000033", "tmdb_id": 7033, "budget": None, "revenue": None, "runtime": 25,
     "origin_country": ["NZ"], "genre": ["Comedy", "Family"], "tmdb_rating": 7.7,
     "rt_score": 83, "imdb_rating": 7.5, "imdb_votes": 2290},
]


def media_df(spark, records=None):
    from ledgerline.sources.spec import load_samples

    return load_samples(spark, records if records is not None else MEDIA_SAMPLES, media_spec())
