"""The four retail tables: column types, date forms, defaults and audit rules in one object each."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    IntegralType,
    LongType,
    NumericType,
    StringType,
    StructField,
    StructType,
)

from spokewise.functions.dates import LENIENT_DATE, STRICT_DATE
from spokewise.functions.rules import AtLeast, DateFormat, GreaterThan, InSet, Present, Rule


@dataclass(frozen=True)
class TableSpec:
    """What is known about a table.

    ``median_repair``: numeric columns whose negative values give way to the column median.
    ``median_fill``: columns whose missing values are filled with that median.
    ``defaults``: constants for missing values in other columns.
    """

    name: str
    schema: StructType
    rules: tuple[Rule, ...]
    date_formats: Mapping[str, str] = field(default_factory=dict)
    defaults: Mapping[str, object] = field(default_factory=dict)
    median_repair: tuple[str, ...] = ()
    median_fill: tuple[str, ...] = ()

    def __post_init__(self):
        check_defaults(self.schema, self.defaults)
        domains = {r.column: r.values for r in self.rules if isinstance(r, InSet)}
        for column, value in self.defaults.items():
            if value not in domains.get(column, (value,)):
                raise ValueError(f"{self.name}: default {value!r} is outside the domain of {column}")
        for column in (*self.median_repair, *self.median_fill):
            if not isinstance(self.schema[column].dataType, NumericType):
                raise ValueError(f"{self.name}: {column} has no median")


def check_defaults(schema: StructType, defaults: Mapping[str, object]) -> None:
    """Refuse a default that does not fit its column; Spark would skip or cut it without a word."""
    for column, value in defaults.items():
        data_type = schema[column].dataType
        if isinstance(data_type, StringType):
            fits = isinstance(value, str)
        elif isinstance(data_type, IntegralType):
            fits = type(value) is int
        else:
            fits = isinstance(data_type, NumericType) and type(value) in (int, float)
        if not fits:
            raise ValueError(f"default {value!r} does not fit {column} {data_type.simpleString()}")


def _table(**columns) -> StructType:
    return StructType([StructField(name, data_type) for name, data_type in columns.items()])


# Valid categories.
CATEGORIES_1 = ("Mountain", "Road")
CATEGORIES_2 = (
    "Elite Road", "Endurance Road", "Triathalon", "Cyclocross", "Over Mountain",
    "Cross Country Race", "Fat Bike", "Trail", "Sport",
)
FRAMES = ("Carbon", "Aluminum")
STATES = (
    "AL", "AK", "AS", "AZ", "AR", "CA", "CO", "CT", "DE", "DC", "FM", "FL", "GA", "GU", "HI",
    "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MH", "MD", "MA", "MI", "MN", "MS", "MO", "MT",
    "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND", "MP", "OH", "OK", "OR", "PW", "PA", "PR",
    "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VI", "VA", "WA", "WV", "WI", "WY",
)
MARITAL_STATUSES = ("Single", "Married")
GENDERS = ("Male", "Female")
EDUCATION_LEVELS = ("High School", "Associate's", "Bachelor's", "Master's", "PhD")
YES_NO = ("Yes", "No")

# Constants for missing entries.
BIKE_DEFAULTS = {"BikeCategory1": "Road", "BikeCategory2": "Sport", "BikeFrame": "Aluminum"}
BIKESHOP_DEFAULTS = {
    "BikeshopCity": "Los Angeles",
    "BikeshopState": "CA",
    "Latitude": 34.052234,
    "Longitude": -118.243685,
}
ORDER_DEFAULTS = {"Quantity": 1}
CUSTOMER_DEFAULTS = {
    "Prefix": "Mr.",
    "FirstName": "John",
    "LastName": "Doe",
    "MaritalStatus": "Single",
    "Gender": "Male",
    "EmailAddress": "johndoe@email.com",
    "EducationLevel": "Bachelor's",
    "Occupation": "Engineer",
    "HomeOwner": "No",
}

BIKES = TableSpec(
    name="bikes",
    schema=_table(
        BikeKey=LongType(),
        BikeModel=StringType(),
        BikeCategory1=StringType(),
        BikeCategory2=StringType(),
        BikeFrame=StringType(),
        BikePrice=IntegerType(),
    ),
    rules=(
        AtLeast("BikeKey", 1),
        InSet("BikeCategory1", CATEGORIES_1),
        InSet("BikeCategory2", CATEGORIES_2),
        InSet("BikeFrame", FRAMES),
        GreaterThan("BikePrice", 0),
    ),
    defaults=BIKE_DEFAULTS,
    median_repair=("BikePrice",),
    median_fill=("BikePrice",),
)

BIKESHOPS = TableSpec(
    name="bikeshops",
    schema=_table(
        BikeshopKey=LongType(),
        BikeshopName=StringType(),
        BikeshopCity=StringType(),
        BikeshopState=StringType(),
        Latitude=DoubleType(),
        Longitude=DoubleType(),
    ),
    rules=(AtLeast("BikeshopKey", 1), InSet("BikeshopState", STATES)),
    defaults=BIKESHOP_DEFAULTS,
)

ORDERS = TableSpec(
    name="orders",
    schema=_table(
        OrderKey=LongType(),
        OrderId=LongType(),
        OrderLine=LongType(),
        CustomerKey=LongType(),
        BikeKey=LongType(),
        Quantity=IntegerType(),
        OrderDate=StringType(),
    ),
    rules=(
        AtLeast("OrderKey", 1),
        AtLeast("OrderId", 1),
        AtLeast("OrderLine", 1),
        AtLeast("CustomerKey", 1),
        AtLeast("BikeKey", 1),
        AtLeast("Quantity", 1),
        Present("OrderDate"),
        DateFormat("OrderDate", LENIENT_DATE),
    ),
    date_formats={"OrderDate": LENIENT_DATE},
    defaults=ORDER_DEFAULTS,
    median_repair=("Quantity",),
)

CUSTOMERS = TableSpec(
    name="customers",
    schema=_table(
        CustomerKey=LongType(),
        Prefix=StringType(),
        FirstName=StringType(),
        LastName=StringType(),
        BirthDate=StringType(),
        MaritalStatus=StringType(),
        Gender=StringType(),
        EmailAddress=StringType(),
        AnnualIncome=IntegerType(),
        TotalChildren=IntegerType(),
        EducationLevel=StringType(),
        Occupation=StringType(),
        HomeOwner=StringType(),
    ),
    rules=(
        AtLeast("CustomerKey", 1),
        InSet("MaritalStatus", MARITAL_STATUSES),
        InSet("Gender", GENDERS),
        InSet("EducationLevel", EDUCATION_LEVELS),
        InSet("HomeOwner", YES_NO),
        AtLeast("TotalChildren", 0),
        AtLeast("AnnualIncome", 0),
        Present("BirthDate"),
        DateFormat("BirthDate", STRICT_DATE),
    ),
    date_formats={"BirthDate": STRICT_DATE},
    defaults=CUSTOMER_DEFAULTS,
    median_repair=("AnnualIncome", "TotalChildren"),
    median_fill=("AnnualIncome", "TotalChildren"),
)

TABLES = {spec.name: spec for spec in (BIKES, BIKESHOPS, ORDERS, CUSTOMERS)}
