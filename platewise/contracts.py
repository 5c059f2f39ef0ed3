"""Column contracts of every dataset. Columns are found by name, never by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Names and labels that inputs and outputs must carry.
MENU_SHEET_COLUMNS = {
    "Menu ID": "menu_id",
    "Menu Start Date": "CREATION_TIMESTAMP",
    "Item Id": "ITEM_ID",
    "Meal Id": "meal_id",
    "Meal(En)": "Meal",
    "Ingredients(En)": "Ingredients",
    "Allergens Contains(En)": "AllergensContains",
    "Allergens May Contains(En)": "AllergensMayContains",
    "Spicy": "Spicy",
    "gluten_free": "gluten_free",
}
MENU_SHEET_REQUIRED = ("Meal(En)", "Ingredients(En)")
USER_COLUMNS = (
    "user_id", "deleted_at", "shipping_city", "shipping_state", "grandpa",
    "subscribed", "locale", "last_login_at", "created_at", "subscribed_at",
)
USER_DATE_COLUMNS = ("last_login_at", "created_at", "subscribed_at")
USER_TAGS = (
    ("vegetable_side_dish", "vegetable"),
    ("grandpa", "grandpa"),
    ("subscribed", "subscribed"),
    ("show_meats", "show_meats"),
)
RATING_COLUMNS = ("user_id", "menu_item_id", "rating", "date")
CHOICE_COLUMNS = ("user_id", "menu_item_id", "manual", "created_at")
RATING_EVENT = "Watch"
CHOICE_EVENT = "Click"
EVENT_LABELS = {"Watch": "+3 rating", "Click": "Selection"}
# End of the fixed values.


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_TEXT, _LONG, _INT, _DOUBLE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
_LIST = T.ArrayType(T.StringType())

INTERACTIONS = _schema(
    USER_ID=_TEXT, ITEM_ID=_TEXT, EVENT_TYPE=_TEXT, EVENT_VALUE=_DOUBLE, TIMESTAMP=_LONG, LIKED=_INT)
MENUS_CURATED = _schema(
    ITEM_ID=_TEXT, PRICE=T.DecimalType(10, 2), CREATION_TIMESTAMP=_LONG, NAME=_TEXT, GENRES=_TEXT,
    GENRE_L2=_TEXT, GENRE_L3=_TEXT, PRODUCT_DESCRIPTION=_LIST, CONTENT_CLASSIFICATION=_TEXT)
USERS_CURATED = _schema(
    USER_ID=_TEXT, INTEREST=_LIST, CITY=_TEXT, STATE=_TEXT, LOCALE=_TEXT, CREATED_AT=_LONG)

USERS_TABLE = _schema(
    user_id=_TEXT, shipping_city=_TEXT, shipping_state=_TEXT, locale=_TEXT, created_at=_LONG)
MENUS_TABLE = _schema(
    item_id=_TEXT, created_at=_LONG, name=_TEXT, genres=_TEXT, genre_l2=_TEXT, genre_l3=_TEXT,
    product_description=_LIST, content_classification=_TEXT)
INTERACTIONS_TABLE = _schema(
    item_id=_TEXT, user_id=_TEXT, event_type=_TEXT, event_value=_DOUBLE, created_at=_LONG, liked=_INT)
INGREDIENTS_TABLE = _schema(name=_TEXT, count=_LONG)


def _flag(name: str, kind: T.DataType, **metadata: bool) -> T.StructField:
    return T.StructField(name, kind, True, metadata)


# The import schemas of a recommender, with its column flags as metadata.
EXPORT_ITEMS = T.StructType([
    _flag("ITEM_ID", _TEXT),
    _flag("PRICE", T.FloatType()),
    _flag("CREATION_TIMESTAMP", _LONG),
    _flag("GENRES", _TEXT, categorical=True),
    _flag("GENRE_L2", _TEXT, categorical=True),
    _flag("GENRE_L3", _TEXT, categorical=True),
    _flag("PRODUCT_DESCRIPTION", _TEXT, textual=True),
    _flag("CONTENT_CLASSIFICATION", _TEXT, categorical=True),
])
EXPORT_INTERACTIONS = T.StructType([
    _flag("USER_ID", _TEXT),
    _flag("ITEM_ID", _TEXT),
    _flag("EVENT_TYPE", _TEXT),
    _flag("EVENT_VALUE", T.FloatType()),
    _flag("TIMESTAMP", _LONG),
])
EXPORT_USERS = T.StructType([
    _flag("USER_ID", _TEXT),
    _flag("INTEREST", _TEXT, categorical=True),
])
# End of the fixed values.


def require_columns(df: DataFrame, names) -> DataFrame:
    """Stop with the missing names when a required column is absent."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"required columns not found: {', '.join(missing)}")
    return df


def keep_columns(df: DataFrame, names) -> DataFrame:
    """Keep the listed columns in list order; a mapping also renames. Absent ones are left out."""
    renamed = names if isinstance(names, dict) else {name: name for name in names}
    return df.select([F.col(f"`{src}`").alias(dst) for src, dst in renamed.items() if src in df.columns])


def _lenient(column: Column, kind: T.DataType) -> Column:
    return column.try_cast(kind)


def to_contract(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to the contract; a value that does not fit its type becomes null, never NaN."""
    require_columns(df, schema.fieldNames())
    columns = []
    for field in schema.fields:
        source = F.col(field.name)
        actual = df.schema[field.name].dataType
        if isinstance(actual, T.ArrayType) and isinstance(field.dataType, T.StringType):
            source = F.array_join(source, "|")
        elif isinstance(actual, T.StringType) and isinstance(field.dataType, T.ArrayType):
            source = F.split(source, r"\|")
        value = source if actual == field.dataType else _lenient(source, field.dataType)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            value = F.when(~F.isnan(value), value)
        columns.append(value.alias(field.name, metadata=field.metadata) if field.metadata
                       else value.alias(field.name))
    return df.select(columns)
