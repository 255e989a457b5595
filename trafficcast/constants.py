"""They must equal the published configuration for right results."""

# Applications forecast by default.
DEFAULT_APPS = ("DNS", "DHCP", "Radius", "LDAP", "Kerberos")

# A series is modelled when it has strictly more points than this.
POINT_LIMIT = 60

# Points kept, and needed, for an hourly (48-hour) model.
HOURLY_TAIL = 90

# Steps to forecast, and to hold out for validation.
DELAY_DAYS = 30
DELAY_HOURS = 48

# Days of measurements kept in the store.
RETENTION_DAYS = 90

# Non-null points the response-time report needs after outlier removal.
MIN_USABLE_POINTS = 10

# Bandwidth is the byte sum of an hour divided by this.
BANDWIDTH_DIVISOR = 8 * 3600

# History rows averaged by the lag features; horizons of the direct models.
HISTORY_LAG = 5
MULTI_HORIZON = 30

# Percentile range of the robust scaler.
ROBUST_LOWER, ROBUST_UPPER = 0.05, 0.95

# Boosted-tree settings.
BOOST_DEPTH, BOOST_ETA, BOOST_ROUNDS, BOOST_MIN_CHILD = 3, 0.02, 200, 3

# Measures averaged for the model features, in column order.
FEATURE_MEASURES = (
    "app_rsp_time",
    "byte_count",
    "flow_count",
    "rx_byte_count",
    "rx_flow_count",
    "tcp_rsp_time",
    "tx_byte_count",
    "tx_flow_count",
)

MS_PER_HOUR = 3_600_000
MS_PER_DAY = 24 * MS_PER_HOUR
