"""Column and table contracts.

A contract says, for every output column, which raw column feeds it, how the
text is validated and typed, what a NULL becomes, and which keys and checks
the finished table must satisfy.  ``marquee.operators.clean.apply_contract``
turns a contract into one ``select``; ``marquee.operators.quality`` turns the
key and check declarations into violation reports.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from marquee.functions.validators import FLOAT_SENTINEL, INT_SENTINEL

# Validator kinds understood by apply_contract.
STRICT_INT = "strict_int"      # digits only
SIGNED_INT = "signed_int"      # optional sign and digits, no default
NUMERIC_INT = "numeric_int"    # any numeric text, truncated
STRICT_FLOAT = "strict_float"  # unsigned decimal, no exponent
DATE = "date"                  # yyyy-M-d, else NULL
JSON_LIST = "json_list"        # literal / JSON list of objects -> canonical JSON
TEXT = "text"                  # kept as is
KINDS = {STRICT_INT, SIGNED_INT, NUMERIC_INT, STRICT_FLOAT, DATE, JSON_LIST, TEXT}


@dataclass(frozen=True)
class Col:
    source: str
    name: str
    kind: str = TEXT
    dtype: str = "string"
    default: object = None
    nullable: bool = True
    strip_leading: str | None = None

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown kind {self.kind!r}")


@dataclass(frozen=True)
class Check:
    """Row predicate that must hold (NULL passes, as in SQL CHECK)."""
    name: str
    sql: str


@dataclass(frozen=True)
class TableContract:
    name: str
    columns: tuple[Col, ...]
    primary_key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    checks: tuple[Check, ...] = field(default_factory=tuple)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def sources(self) -> list[str]:
        return [c.source for c in self.columns]

    @property
    def defaulted(self) -> list[str]:
        """Source columns that an input may lack."""
        return [c.source for c in self.columns if c.nullable or c.default is not None]

    def ddl(self) -> str:
        return ", ".join(
            f"{c.name} {c.dtype}{'' if c.nullable else ' NOT NULL'}" for c in self.columns)


# ---- the four film tables -------------------------------------------------
# Table, column and file-column names must equal the source system's.

# What links and metadata are joined on.
FILM_IDS = ("tmdb_id", "imdb_id")

MOVIE_LINKS = TableContract(
    name="movie_links",
    columns=(
        Col("movieId", "movie_id", NUMERIC_INT, "int", INT_SENTINEL),
        Col("imdbId", "imdb_id", NUMERIC_INT, "int", INT_SENTINEL),
        Col("tmdbId", "tmdb_id", NUMERIC_INT, "int", INT_SENTINEL),
    ),
    primary_key=("movie_id", "imdb_id"),
    unique=(("movie_id",), ("movie_id", "imdb_id", "tmdb_id")),
)

MOVIES_METADATA = TableContract(
    name="movies_metadata",
    columns=(
        Col("id", "tmdb_id", STRICT_INT, "int", INT_SENTINEL),
        Col("imdb_id", "imdb_id", STRICT_INT, "int", INT_SENTINEL, strip_leading="t"),
        Col("genres", "genres", JSON_LIST, "string", "[]"),
        Col("original_title", "original_title", TEXT, "string", nullable=False),
        Col("title", "title", TEXT, "string"),
        Col("budget", "budget", STRICT_FLOAT, "double", FLOAT_SENTINEL, nullable=False),
        Col("release_date", "release_date", DATE, "date"),
        Col("revenue", "revenue", STRICT_FLOAT, "double", FLOAT_SENTINEL, nullable=False),
        Col("production_companies", "production_companies", JSON_LIST, "string", "[]"),
    ),
    primary_key=("tmdb_id",),
    unique=(("tmdb_id", "imdb_id", "release_date"),),
)

MOVIE_RATINGS = TableContract(
    name="movie_ratings",
    columns=(
        Col("movie_id", "movie_id", TEXT, "int"),
        Col("rating", "rating", TEXT, "double"),
    ),
    primary_key=("movie_id",),
    checks=(Check("rating_at_most_5", "rating <= 5.0"),),
)

TOP_MOVIES = TableContract(
    name="top_movies",
    columns=(
        Col("title", "title"),
        Col("budget", "budget", TEXT, "double", nullable=False),
        Col("year", "year", TEXT, "int"),
        Col("revenue", "revenue", TEXT, "double", nullable=False),
        Col("rating", "rating", TEXT, "double"),
        Col("ratio", "ratio", TEXT, "double"),
        Col("production_companies", "production_companies"),
        Col("wiki_url", "wiki_url"),
        Col("wiki_abstract", "wiki_abstract"),
    ),
    primary_key=("title", "year", "production_companies"),
    unique=(("title", "year", "wiki_url"),),
)

# Ratings files are read by position with this schema (header skipped), as text:
# ids are checked before they are typed, and a rating that is no number is NULL.
RATINGS_FILE_DDL = "user_id STRING, movie_id STRING, rating STRING, timestamp STRING"
RATING_ROWS = TableContract(
    name="rating_rows",
    columns=(
        Col("movie_id", "movie_id", SIGNED_INT, "int", nullable=False),
        Col("rating", "rating", TEXT, "double"),
    ),
)
