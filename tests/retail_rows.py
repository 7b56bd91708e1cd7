"""Small invented retail tables with every kind of dirt."""

from spokewise.schemas import BIKES, BIKESHOPS, CUSTOMERS, ORDERS

BIKE_ROWS = [
    (1, "Alpha", "Road", "Endurance Road", "Carbon", 3000),
    (2, "Beta", "Mountain", "Trail", "Aluminum", 1200),
    (2, "Beta", "Mountain", "Trail", "Aluminum", 1200),
    (3, "Gamma", None, None, None, None),
    (4, "Delta", "Road", "Sport", "Carbon", -50),
    (5, "Epsilon", "Tandem", "Hover", "Bamboo", 900),
]
BIKESHOP_ROWS = [
    (1, "North Wheels", "Boston", "MA", 42.3, -71.0),
    (1, "North Wheels", "Boston", "MA", 42.3, -71.0),
    (2, "Lost Shop", None, None, None, None),
    (3, "Far Shop", "Paris", "XX", 48.8, 2.3),
]
CUSTOMER_ROWS = [
    (1, "Mr.", "Ann", "Ash", "03/04/1990", "Single", "Female", "a@x.org", 50000, 0, "PhD", "Vet", "Yes"),
    (1, "Mr.", "Ann", "Ash", "03/04/1990", "Single", "Female", "a@x.org", 50000, 0, "PhD", "Vet", "Yes"),
    (2, None, None, None, None, None, None, None, None, None, None, None, None),
    (3, "Mrs.", "Cat", "Cole", "1/2/1999", "Married", "Female", "c@x.org", -1, -2, "Master's", "Chef", "No"),
    (4, "Mr.", "Dan", "Dole", "31/13/2000", "Widowed", "Other", "d@x.org", 70000, 3, "School", "Cook", "Maybe"),
    (5, "Mr.", "Eve", "Eads", "10/11/1980", "Single", "Female", "e@x.org", 60000, 1, "PhD", "Poet", "No"),
]
# customer 5 orders nothing, customer 99 is unknown, (1, 1) is bought twice
ORDER_ROWS = [
    (1, 1, 1, 1, 1, 2, "01/03/2020"),
    (1, 1, 1, 1, 1, 2, "01/03/2020"),
    (2, 1, 2, 1, 2, 5, "01/03/2020"),
    (3, 2, 1, 2, 1, None, "1/4/2020"),
    (4, 3, 1, 3, 3, -7, "15/04/2021"),
    (5, 4, 1, 4, 4, 4, "31/13/2000"),
    (6, 5, 1, 99, 1, 3, "16/04/2021"),
    (7, 6, 1, 1, 1, 4, None),
    (8, 7, 1, 2, 5, 6, "20/05/2022"),
]
ROWS = {
    "bikes": (BIKES, BIKE_ROWS),
    "bikeshops": (BIKESHOPS, BIKESHOP_ROWS),
    "customers": (CUSTOMERS, CUSTOMER_ROWS),
    "orders": (ORDERS, ORDER_ROWS),
}


def frame(spark, name):
    spec, rows = ROWS[name]
    return spark.createDataFrame(rows, spec.schema)
