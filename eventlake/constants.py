"""Fixed values that must equal the reference behaviour for identical output.

Fixed values: event-time patterns (tried in this order), messages, stage
names, lineage property names, processor field names.
"""

# Event-time text patterns, tried in this order.
TIME_PATTERNS = (
    "yyyy-MM-dd HH:mm:ss.SSS",
    "yyyy-MM-dd HH:mm:ss SSS",
    "yyyy-MM-dd HH:mm:ss.0",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy/MM/dd HH:mm:ss",
    "yyyyMMddHHmmss",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd",
    "yyyyMMdd",
)

# Validation messages and their separator.
ERR_NO_ID = "No ID, login or device, is presented!"
ERR_TIME = "Time format is invalid!"
ERR_EVENT = "Event Name is not presented!"
ERR_SEP = " || "
INVALID_PREFIX = " invalid-rule is : "
EXCEPTION_PREFIX = "invalid-rule is: "
DECODE_ERROR_PREFIX = "Record handle exception: "
NULL_RECORD = "Null Record"
VERSION_TAG = "InvalidTag"

# Stage names of the record counters.
STAGE_NULL = "0-NULL"
STAGE_SOURCE = "1-SOURCE"
STAGE_INVALID = "2-INVALID"
STAGE_NEED_SPLIT = "3-NEED_SPLIT"
STAGE_SPLIT = "4-SPLIT"
STAGE_SIGNUP = "6-SIGNUP"
STAGE_SINK = "7-SINK"
# Ours: parts that failed validation (the reference counts none).
STAGE_VALIDATION = "8-VALIDATION"

# Lineage and overlay property names.
PROP_RECORD_KEY = "RECORD_KEY"
PROP_SERVER = "SACONSUMERSERVER"
PROP_GROUP = "SACONSUMERGROUP"
PROP_TOPIC = "SACONSUMERTOPIC"
PROP_PARTITION = "SACONSUMERPARTITION"
PROP_OFFSET = "SACONSUMEROFFSET"
PROP_DATE = "date"
PROP_APP_VERSION = "$app_version"
PROP_DEVICE_ID = "$device_id"
PROP_EVENT_NAME = "event_name"
PROP_LOGIN_ID = "login_id"
PROP_IS_LOGIN_ID = "$is_login_id"

# Output event constants.
TYPE_TRACK = "track"
TYPE_SIGNUP = "track_signup"
EVENT_SIGNUP = "$SignUp"
SIGNUP_EVENTS = ("Login", "register")
SIGNUP_DEVICE_PROPERTY = "device_id"
PROFILE_TYPE = "profile_set"
PROFILE_PROJECT_PREFIX = "SA_"
PROFILE_USER_ID_PROPERTY = "pa_userid"

# Record processors and the JSON field names each one reads.
PROCESSOR_FIELDS = {
    "corpBankOldEvent": {
        "app_version": "AppVersion", "device_id": "DeviceID", "event_name": "LogType",
        "event_time": "Time", "login_id": "CustID", "project": None,
    },
    "corpBankNewEvent": {
        "app_version": "AppVersion", "device_id": "DeviceID", "event_name": "LogType",
        "event_time": "Time", "login_id": "CustID", "project": None,
    },
    "uniLogPlatformEvent": {
        "app_version": "AppVersion", "device_id": "DeviceID", "event_name": "EventID",
        "event_time": "Time", "login_id": "LoginID", "project": "project",
    },
}
LOG_FIELD = "LOG"
DEFAULT_PROCESSOR = "uniLogPlatformEvent"
DEFAULT_CONVERTER = "emptyConverter"
DEFAULT_POST_PROCESSOR = "uniLogPlatformPost"

# Sample index -> field name map of the delimited converter.
CSV_FIELDS = {1: "fn1", 2: "fn2", 3: "fn3", 4: "fn4", 5: "fn5"}
CSV_SEPARATOR = "\u0001"

# Property rule type codes.
RULE_NUMBER, RULE_BOOL, RULE_STRING, RULE_DATETIME, RULE_LIST = 0, 1, 2, 3, 4
