"""Fixed values of the spend report.

Everything in this module must equal the business definition of the report for
results to be right: charge-code lists, ship-mode prefixes, month labels and the
reference / milestone code lists.  They are stated here plainly, in their natural
order, and every rule function, plan and oracle reads them from this one place.
"""

# --- fixed values: charge types by billing code (first matching rule wins) ---
FREIGHT_CODES = (
    "2102", "2123", "2130", "4000", "4001", "4002", "4004", "4030", "4402",
    "4408", "4421", "4422", "4469", "4506", "4701", "4709", "AMSA", "P/UT",
)
DUTY_CODES = ("2101",)
# code 2100 is Duty only when the line description is exactly this text
DUTY_SPECIAL_CODE = "2100"
DUTY_SPECIAL_DESCRIPTION = "K84"
CUSTOMS_CODES = ("0201", "0701", "2100", "4003", "4592")
DELIVERY_CODES = ("0130", "0131", "2106", "4401", "4403", "4423", "4429", "4480", "V093")
DESTINATION_CODES = ("2115", "4007", "4024", "4597", "4643", "4645", "V163", "V192", "V197")
ORIGIN_FEE_CODES = (
    "2118", "4018", "4031", "4083", "4087", "4461", "4462", "4463", "4703",
    "4708", "4754", "V196",
)
OTHER_CODES = ("2190", "4590", "V098", "Z408")

FREIGHT = "Freight"
DUTY = "Duty"
CUSTOMS = "Customs"
DELIVERY = "Delivery"
DESTINATION = "Destination Charges"
ORIGIN_FEES = "Origin Fees"
OTHER = "Other"
# variant rule set: delivery and destination codes reported as one category
DESTINATION_AND_DELIVERY = "Destination & Delivery Charges"

# --- fixed values: ship mode by first character of the internal reference ---
SHIP_MODE_BY_PREFIX = (
    ("J", "Truck"),
    ("H", "Truck"),
    ("1", "Truck"),
    ("2", "Air"),
    ("3", "Air"),
    ("4", "Air"),
    ("5", "Ocean"),
    ("6", "Ocean"),
    ("7", "Ocean"),
    ("8", "Truck"),
    ("9", "Distribution"),
)
SHIP_MODE_OTHER = "Other"

# --- fixed values: foreign-to-foreign markers ---
F2F_DESCRIPTION_MARKERS = ("F2F", "FOREIGN TO FOREIGN")
F2F_USAGE_PREFIX = "F2F"
F2F_CUSTOMER_USAGE = "F2FC"

# --- fixed values: exclusion of billing code + branch country code ---
EXCLUDED_CODE_COUNTRY = "2125MX"

# --- fixed values: month labels, January to December (ninth is "09-Sept") ---
MONTH_LABELS = (
    "01-Jan", "02-Feb", "03-Mar", "04-Apr", "05-May", "06-Jun",
    "07-Jul", "08-Aug", "09-Sept", "10-Oct", "11-Nov", "12-Dec",
)

# --- fixed values: reference types pivoted per invoice ---
IMPORT_REFERENCE_TYPES = ("IC", "PO", "CI", "EN", "MB", "DP")
EXPORT_REFERENCE_TYPES = ("SO", "IC", "PO", "CI", "EN", "MB", "DP")

# --- fixed values: milestone event codes ---
# codes joined for the import leg (POD is not among them, EDE has no column)
IMPORT_EVENT_CODES = (
    "FRT", "ADU", "COB", "FND", "ADD", "AFD", "DLV", "BKD", "EDA", "EDI", "EDE", "EDS",
)
# milestone columns produced for the import leg
IMPORT_MILESTONES = (
    "FRT", "POD", "ADU", "FND", "ADD", "AFD", "DLV", "COB", "BKD", "EDA", "EDI", "EDS",
)
EXPORT_EVENT_CODES = ("EDI", "EDA", "EDS")
EXPORT_MILESTONES = ("EDA", "EDI", "EDS")

# --- fixed values: container roll-up ---
ROLLUP_WIDTH = 31
ROLLUP_SEPARATOR = "|"
OCEAN = "Ocean"

# --- fixed values: sanitising for delimited export ---
QUOTE = '"'
COMMA = ","
