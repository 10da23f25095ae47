"""Fixed values shared by the operators."""

# Label namespaces of a record.
USER_INFO = "user_info"
AREA_ONSITE = "area_onsite"
AREA_ONSITE_STAY = "area_onsite_stay"
AREA_INFO = "area_info"
EXT_LAST_IMEI = "ext_last_imei"
EXT_USERTRACK = "ext_usertrack"

# The subscriber id that stands for "unknown".
ANONYMOUS_ID = "000000000000000"

# Event numbers whose subject is the called party, and the message-like ones
# whose subject depends on the ``issmsalone`` field.
CALLED_EVENTS = (3, 5, 7)
MESSAGE_EVENTS = (8, 9, 10, 26)

# Defaults in milliseconds.
STAY_TIMEOUT_MS = 30 * 60 * 1000
COOLDOWN_MS = 7 * 24 * 60 * 60 * 1000
CORRELATION_DELAY_MS = 30 * 60 * 1000
LOOKUP_TTL_SECONDS = 30 * 60
