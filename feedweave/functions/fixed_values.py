"""Contract constants that decide results. Stated as given."""

# Characters kept when a field is cleaned: letters, digits, point, space, slash, hyphen.
PLAIN_TEXT = "[^0-9A-Za-z. /-]"
# Characters kept for group ids: letters and digits only.
ALNUM_ONLY = "[^0-9A-Za-z]"

DATE_PATTERN = "yyyyMMdd"
TIME_PATTERN = "HH:mm:ss"

# Delimiters of the source and feed files.
FIELD_SEPARATOR = "\u0001"
FEED_SEPARATOR = "|"

# End date of the current row in a history table.
OPEN_END = "9999-12-31"

# Record types in the sales table.
HEADER_RECORD = 1000
LINE_RECORD = 1100

# Source codes in the identity history: loyalty and online account.
LOYALTY_SOURCE = "LR"
ONLINE_SOURCE = "EC"

ACTIVE_STATUS = "Activated"

# Sensitive operating-study codes.
SENSITIVE_STUDY_CODES = (74, 174, 214, 37, 212, 15)

# Sensitive category: name part and codes.
SENSITIVE_CATEGORY_NAME = "PRENATAL"
SENSITIVE_CATEGORY_CODES = (
    1007, 907907, 908908, 73015, 73016, 74001, 74002, 74003, 74004, 74005,
    74006, 74007, 74008, 74009, 74010, 74011, 74012, 74013, 74014, 74015,
    74016, 74017, 74018, 74019, 174001, 174003, 174006, 174007, 174008, 174010,
    174013, 174016, 174017, 192011, 212001, 212002, 212003, 212004, 212005, 212006,
    212007, 212008, 212010, 212011, 212012, 212013, 212014, 212068, 212069, 214001,
    214002, 214003, 214004, 214005, 214006, 214007, 35013, 35021, 129006, 136002,
    46001, 46017, 46015, 213012, 50022, 3045, 153008, 85006, 3115, 57002,
    2054, 165004, 197122, 2090, 138006, 19119, 173130, 117010, 90067, 25006,
    9001, 70010, 138022, 90007, 176028, 82033, 3110, 39012, 199199, 4092,
    14008, 104108, 902902, 145008, 205010, 133007,
)

# Excluded region: state code and city name part.
EXCLUDED_STATE = "WA"
EXCLUDED_CITY = "washington"

# Key offsets and protection key ids.
PRESCRIPTION_KEY_OFFSET = 152
MEMBER_KEY_OFFSET = 845
PRESCRIPTION_KEY_ID = "3000"
PERSON_KEY_ID = "1"
CONTACT_KEY_ID = "8000"

# States whose prescriber registration numbers are withheld.
WITHHELD_PRESCRIBER_STATES = ("WI", "MN")

# Payment type: cash-like methods, and government plan codes as (start, text).
CASH_METHODS = ("C", "O")
GOVERNMENT_PLAN_PARTS = ((3, "DPA"), (3, "MED"), (4, "PA"), (3, "PA "), (1, "GAM"), (1, "MAM"))

# Store rules of the second extract variant.
MAIL_STORES = ("03397", "09599")
PROVIDER_ID_BY_STORE = {"09599": "9999999"}
ZIP_BY_STORE = {"11847": "00918", "16034": "08628"}

MAIL_STORE_TYPE = "04"
MISSING_PROVIDER_ID = "PATIENT_ZIP"

RECORD_WIDTH = 708

# Consent cohorts and contact file columns.
CONSENT_TAGS = ("ConsentA", "ConsentB")
CONTACT_COLUMNS = (
    "PATIENT_ID", "PROTOCOL_ID", "PATIENT_FIRST_NAME", "PATIENT_LAST_NAME", "DOB", "PREFERRED_METHOD",
    "EMAIL", "PHONE_SMS", "LOCATION_NAME", "LOCATION_ID", "PATIENT_LANGUAGE",
)
