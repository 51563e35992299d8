"""Target tables and the fields read from the inputs. Nothing is ever inferred."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_TYPES = {
    "text": T.StringType(),
    "json": T.VariantType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


@dataclass(frozen=True)
class Table:
    """A target table: ordered columns, key, not-null columns and parent reference."""

    name: str
    columns: dict[str, str]
    key: tuple[str, ...]
    not_null: tuple[str, ...] = ()
    parent: str | None = None
    parent_key: str | None = None
    source: dict[str, str] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        required = set(self.key) | set(self.not_null)
        return T.StructType([T.StructField(n, _TYPES[k], n not in required) for n, k in self.columns.items()])

    def of_kind(self, *kinds: str) -> list[str]:
        return [n for n, k in self.columns.items() if k in kinds]


def _columns(text: str) -> dict[str, str]:
    """`name:kind name name ...`; a bare name is text."""
    pairs = (word.partition(":") for word in text.split())
    return {name: kind or "text" for name, _, kind in pairs}


# Column names, order, types and keys of the tables and inputs.

GAME = Table(
    "dim_game_info",
    _columns("""
        unified_app_id canonical_app_id name cohort_id itunes_apps:json android_apps:json unified_publisher_ids:json
        itunes_publisher_ids:json android_publisher_ids:json game_class game_genre game_subgenre game_art_style
        game_camera_pov game_setting game_theme game_product_model game_ip_corporate_parent game_ip_operator
        game_ip_media_type game_licensed_ip game_earliest_release_date:date game_release_date_ww:date
        game_release_date_us:date game_release_date_jp:date game_release_date_cn:date
    """),
    key=("unified_app_id",),
)

APP = Table(
    "dim_app_info",
    _columns("""
        app_id canonical_country name publisher_name publisher_id humanized_name icon_url os active:boolean url
        categories:json valid_countries:json top_countries:json app_view_url publisher_profile_url
        release_date:timestamp updated_date:timestamp in_app_purchases:boolean rating:double price:double
        global_rating_count:int rating_count:int rating_count_for_current_version:int
        rating_for_current_version:double version apple_watch_enabled:boolean imessage_enabled:boolean imessage_icon
        humanized_worldwide_last_month_downloads:json humanized_worldwide_last_month_revenue:json bundle_id support_url
        website_url privacy_policy_url eula_url publisher_email publisher_address publisher_country feature_graphic
        short_description advisories:json content_rating unified_app_id screenshot_urls:json tablet_screenshot_urls:json
        description subtitle promo_text permissions:json supported_languages:json country_release_date:timestamp
        cleaned_publisher_name revenue_multiplier:int
    """),
    key=("app_id",),
    parent="dim_game_info",
    parent_key="unified_app_id",
)

DAILY = Table(
    "fact_app_performance_daily",
    _columns("""
        app_id country_android country_ios date:timestamp downloads_android:bigint downloads_iphone:bigint
        downloads_ipad:bigint revenue_android:bigint revenue_iphone:bigint revenue_ipad:bigint
    """),
    key=("app_id", "date", "country_android", "country_ios"),
    parent="dim_app_info",
    parent_key="app_id",
    source={
        "app_id": "aid", "country_android": "c", "country_ios": "cc", "date": "d",
        "downloads_android": "u", "downloads_iphone": "iu", "downloads_ipad": "au",
        "revenue_android": "r", "revenue_iphone": "ir", "revenue_ipad": "ar",
    },
)

PC_GAME = Table(
    "dim_pc_game_info",
    _columns("""
        app_id:int name game_class game_genre game_subgenre developer publisher language initial_price:double
        release_date:date steam_genres steam_tags description
    """),
    key=("app_id",),
)

MONTHLY = Table(
    "fact_pc_game_performance_monthly",
    _columns("app_id:int month:date peak_ccu:bigint"),
    key=("app_id", "month"),
    parent="dim_pc_game_info",
    parent_key="app_id",
)

TABLES = {t.name: t for t in (GAME, APP, DAILY, PC_GAME, MONTHLY)}

# The two CSV layouts of the app dimension; columns are bound by position.
APP_CSV = list(APP.columns)
APP_CSV_SHORT = [c for c in APP.columns if c != "rating_count"]


# Sorts lines in file order: file, start of the input split, row counter within the task.
POSITION = ["file", "block", "pos"]


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


REJECTS = T.StructType([
    T.StructField("line_no", T.LongType()), T.StructField("line", T.StringType()), T.StructField("reason", T.StringType()),
])
PROGRESS = T.StructType([
    T.StructField("batch", T.LongType()), T.StructField("started_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()), T.StructField("total_lines", T.LongType()),
    T.StructField("processed_lines", T.LongType()), T.StructField("inserted_rows", T.LongType()),
])
