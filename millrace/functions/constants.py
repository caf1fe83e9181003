"""Fixed values of the data model."""

import datetime as dt

# open-end dates of validity intervals
OPEN_END = dt.date(2999, 12, 31)
OPEN_END_FAR = dt.date(9999, 12, 31)
OPEN_END_FAR_TS = "9999-12-31 00:00:00"
OPEN_TERM_TS = "9999-12-31 23:59:59.999"

# first moment used when a pipeline never ran
NEVER_RAN = dt.datetime(1900, 1, 1)

# change indicators
INSERTS = ("INS",)
UPDATES = ("UPD",)
DELETES = ("DEL",)

# rating texts that count as "no value"
NO_VALUE_TEXTS = ("NR", "WR", "WD", "PIF", "nan", "NaN", "None", "", "N/A")

# job states
STARTED = "STARTED"
IN_PROGRESS = "IN_PROGRESS"
SUCCESS = "SUCCESS"
FAILURE = "FAILURE"

# type families used when source and target metadata are compared
NUMBER_TYPES = ("int", "decimal")
STRING_TYPES = ("char", "varchar", "varchar2", "string")

# fixed values: catalogue label of each base type in the feed of raw tables
TYPE_LABELS = {
    "timestamp": "Date Time",
    "datetime": "Date Time",
    "date": "Date",
    "string": "Text",
    "varchar": "Text",
    "char": "Text",
    "int": "Whole Number",
    "bigint": "Whole Number",
    "smallint": "Whole Number",
    "boolean": "True/False",
    "decimal": "Decimal Number",
    "bigdecimal": "Decimal Number",
    "double": "Decimal Number",
}

# fixed values: the feed of processed tables leaves these names as they are
UNLABELLED_PROCESSED = ("varchar", "char", "smallint", "double")
