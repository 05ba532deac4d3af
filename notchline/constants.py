"""Constants.

Part 1 lists FIXED VALUES: literals the reference job compares against, kept
verbatim so results agree with it. Part 2 lists the parameters the stand-in
"""

# ---------------------------------------------------------------------------
# Part 1 -- FIXED VALUES (must equal the reference's)
# ---------------------------------------------------------------------------

# Dialect marker: a file whose text contains it is dialect "1.8", else "1.7".
DIALECT_MARKER = "Record FileRecord"
DIALECT_NEW = "1.8"
DIALECT_OLD = "1.7"
# Coordinate scale handed to the profile builder per dialect.
SCALE_NEW = 1000
SCALE_OLD = 1

# Header fields: the station line holds maker, equipment type and station.
STATION_FIELD = "InspectionStationID"
TYPE_FIELD = "domainType"

# Header names of the grid coordinates appended to front points.
GRID_FIELDS = ("testX", "testY")

# Gate literals, in gate order.
EXCLUDED_TYPE = "CIRCL"
EXCLUDED_PITCH = "300000000"
PLACEHOLDER_VALUE = "domainarge"
IMAGE_ID_LENGTH = 12
DEVICE_NONE = "None"
DEVICE_BARE = "BARE"

# Station codes for the eligibility flag: special code, production codes, and
# the code whose absence turns a run with classified points into "not production".
SPECIAL_CODE = "KSP"
PRODUCTION_CODES = ("KT28", "KT29", "KTPU", "KTBF", "KMAC", "RMAC")
MAC_CODE = "MAC"
# Two-sided stations (front and back analysed apart) contain this code.
TWO_SIDED_CODE = "RMAC"
# Review / special-station tag: (!KT28 && !KTBF && KTPU && AMU && RMAC) || SEM.
TAG_ABSENT = ("KT28", "KTBF")
TAG_PRESENT = ("KTPU", "AMU", "RMAC")
TAG_TYPE = "SEM"

# Sides: front is the empty prefix, back is "B".
SIDE_FRONT = ""
SIDE_BACK = "B"

# Arm dimension CSV: field positions, rotation text, side words, sentinels.
ARM_AREA_FIELD = 1
ARM_TOOL_FIELD = 4
ARM_D1_FIELD = 8
ARM_D2_FIELD = 9
ARM_ROT_FIELD = 12
ARM_SIDE_FIELD = 13
ARM_MIN_FIELDS = 5
ARM_ROT_FLAG = "YES"
ARM_ROT_UNIT = "deg"
ARM_SIDE_FRONT = "FRONT"
ARM_SIDE_BACK = "BACK"
MISSING_DIMENSION = -999999.0
NO_ROTATION = 9999.0
FREE_ROTATION_ABOVE = 999.0
# Device reference CSV: the flat position is field 4.
DEVICE_FLAT_FIELD = 4

# Matching: angle tolerance in radians, unit change of r.
ANGLE_TOLERANCE = 0.3
R_UNIT_DIVISOR = 1000.0

# Summary and pattern-table qualifier names.
Q_COUNT = "NO_yES"
Q_COUNT_START = "NO_y"
Q_DETECTION = "y"
Q_TOOL_LIST = "domain_LIST"
Q_TIME_LIST = "TIMESTAMP_LIST"
Q_AREA_LIST = "AREA_LIST"
Q_STATUS = "Email_Status"
Q_POINT = "point"
T_THETA = "THETA:"
T_R = ",R:"
# Header entries copied into the pattern table.
INFO_KEYS_FOR_PATTERN = ("DeviceID", "InspectionStationID")
AREA_ABSENT = "null"

# Sink: cells per write batch, retention of every family in seconds (360 days).
WRITE_BATCH = 1000
RETENTION_SECONDS = 31104000

# ---------------------------------------------------------------------------
# ---------------------------------------------------------------------------

OFF = 50.0  # band tolerance (the reference's dOffset)
ANG = ANGLE_TOLERANCE
MAXLINE = 5  # lines shown of a file of the newer dialect
MAXLINE_OLD = 4  # and of the older
# Lines read of a run's file, by dialect (the reference's maxline18 and maxline17).
LINE_CAP_NEW = 24
LINE_CAP_OLD = 20
# The stand-in files' point list, the line that ends a list, and a first line put before every text.
POINT_LIST = "PointList"
END_OF_LIST = "EndOfList"
FILE_MARK = "#file"
MAXPOINT = 8
HIST_DAYS = 3
RETAIN_DAYS = RETENTION_SECONDS // 86400
BATCH = 100  # the reference's 1000 would leave one batch on the test tables
ANGLE_MATCH_TOL = 0.01
CONSOLIDATE_VALUE_TOL = 2.0

# Hough voting for line detection: theta bins of 10 degrees over [0, 180),
# r bins of width 5, at least 3 votes.
THETA_BINS = 18
R_BIN = 5.0
MIN_VOTES = 3

# Density grid cells (x, y).
GRID_X = 10.0
GRID_Y = 2.0
# and of the finest picture, at several resolutions.
FINE_X = 2.0
FINE_Y = 0.5
