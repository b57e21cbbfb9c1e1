"""Declared schemas and the column names of the published tables."""

from pyspark.sql import types as T


STRING, INT, DOUBLE, BOOLEAN = T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _text(*names: str) -> T.StructType:
    return _struct(**{name: STRING for name in names})


INCOME_LOOKUP = _text("_id", "neighborhood", "neighborhood_name", "neighborhood_reconciled")
RENT_LOOKUP = _text("_id", "ne", "ne_n", "ne_re")
INCOME_DISTRICT_LOOKUP = _text("_id", "district", "district_name", "district_reconciled").add(
    "neighborhood_id", T.ArrayType(STRING)
)
RENT_DISTRICT_LOOKUP = _text("_id", "di", "di_n", "di_re").add("ne_id", T.ArrayType(STRING))
EXTENDED_LOOKUP = _text(
    "district",
    "neighborhood",
    "district_n_reconciled",
    "district_n",
    "district_id",
    "neighborhood_n_reconciled",
    "neighborhood_n",
    "neighborhood_id",
)

# Nested income collection; the name column of the stored documents ends in a space.
INCOME_NAME = "neigh_name "
INCOME = _text(INCOME_NAME, "district_name").add(
    "info", T.ArrayType(_struct(year=INT, RFD=STRING, pop=STRING))
)

RENT = _struct(
    Any=INT,
    Nom_Districte=STRING,
    Nom_Barri=STRING,
    Codi_Districte=STRING,
    Codi_Barri=STRING,
    Lloguer_mitja=STRING,
    Preu=STRING,
)

# Yearly income report: header names as published.
INCOME_REPORT_COLUMNS = [
    "Any",
    "Codi_Districte",
    "Nom_Districte",
    "Codi_Barri",
    "Nom_Barri",
    "Població",
    "Índex RFD Barcelona = 100",
]

# Raw listing, as delivered one JSON array per day.
LISTING = _struct(
    propertyCode=STRING,
    thumbnail=STRING,
    externalReference=STRING,
    numPhotos=INT,
    floor=STRING,
    price=DOUBLE,
    propertyType=STRING,
    operation=STRING,
    size=DOUBLE,
    exterior=BOOLEAN,
    rooms=INT,
    bathrooms=INT,
    address=STRING,
    province=STRING,
    municipality=STRING,
    district=STRING,
    country=STRING,
    neighborhood=STRING,
    latitude=DOUBLE,
    longitude=DOUBLE,
    showAddress=BOOLEAN,
    url=STRING,
    distance=STRING,
    hasVideo=BOOLEAN,
    status=STRING,
    newDevelopment=BOOLEAN,
    hasLift=BOOLEAN,
    priceByArea=DOUBLE,
    detailedType=_text("typology", "subTypology"),
    suggestedTexts=_text("title", "subtitle"),
    parkingSpace=_struct(
        hasParkingSpace=BOOLEAN,
        isParkingSpaceIncludedInPrice=BOOLEAN,
        parkingSpacePrice=DOUBLE,
    ),
    hasPlan=BOOLEAN,
    has3DTour=BOOLEAN,
    has360=BOOLEAN,
    hasStaging=BOOLEAN,
    topNewDevelopment=BOOLEAN,
)

# The listing attributes carried into the formatted tables, besides the code.
LISTING_FIELDS = [
    "date",
    "price",
    "size",
    "rooms",
    "bathrooms",
    "latitude",
    "longitude",
    "operation",
    "propertyType",
    "floor",
]

SURFACE_PRICE = "Surface Price (€/m2)"
MONTHLY_PRICE = "Monthly Price (€/month)"

# Published column name -> our working name.
FLAT_COLUMNS = {
    "Neighborhood": "neighborhood",
    "Neighborhood Id": "neighborhood_id",
    "Neighborhood Code": "neighborhood_code",
    "District Name": "district_name",
    "District Code": "district_code",
    "Property Code": "propertyCode",
    "Date": "date",
    "Price": "price",
    "Size": "size",
    "Rooms": "rooms",
    "Bathrooms": "bathrooms",
    "Latitude": "latitude",
    "Longitude": "longitude",
    "Operation": "operation",
    "PropertyType": "propertyType",
    "Floor": "floor",
    "RFD": "rfd",
    "POP": "pop",
    SURFACE_PRICE: "surface_price",
    MONTHLY_PRICE: "monthly_price",
}
NESTED_COLUMNS = {
    "Neighborhood": "neighborhood",
    "Neighborhood Id": "neighborhood_id",
    "Neighborhood Code": "neighborhood_code",
    "District": "district_name",
    "District Code": "district_code",
    "RFD most recent": "rfd",
    "Population recent": "pop",
    SURFACE_PRICE: "surface_price",
    MONTHLY_PRICE: "monthly_price",
    "Info Idealista": "info",
    "Info Part": "part",
}
