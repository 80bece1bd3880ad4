"""Fixed values.

These texts, codes and thresholds are part of the published results or of the
contract with the systems around the pipeline, so they are stated literally.
"""

# transport types of a result row, and the subset used by the older input
TRANSPORT_TYPES = ("ALL", "VEH", "PUB", "PED", "BIC")
LEGACY_TRANSPORT_TYPES = ("ALL", "VEH", "PED")

# environment codes that are written out
ENVIRONMENT_NAMES = {"EA": "Roadside", "EB": "Indoor"}

# how a panel got its trips
ORIGINAL = "ORIGINAL"
SUBSTITUTE = "SUBSTITUTE"

# panel status and demolition codes
STATUS_ACTIVE = 3
STATUS_WITHDRAWN = (1, 2, 4)
STATUS_OWNER_EXCEPTION = 1
NOT_DEMOLISHED = 0

# motion code of a rotating panel; only its first position is measured
MOTION_ROTATING = "D"
MEASURED_POSITION = 1

# routing difficulty of a panel, by segments per node
DIFFICULTY_LOW = "LOW (Linear/Simple)"
DIFFICULTY_MEDIUM = "MEDIUM (Standard)"
DIFFICULTY_HIGH = "HIGH (Complex Mesh - slow)"
DIFFICULTY_UNDEFINED = "UNDEFINED"
DIFFICULTY_MEDIUM_FROM = "1.5"
DIFFICULTY_MEDIUM_TO = "2.2"

# street line types left out by the older complexity measure
LEGACY_EXCLUDED_LINE_TYPES = ("70", "71", "72")

# work list rows for the visibility calculator
QUEUE_USER = "init_continous_release"
QUEUE_TAG = 50820
LEGACY_QUEUE_TAG = 50020
QUEUE_PRIORITY = 1
QUEUE_LOAD = 0
QUEUE_VACID = 0

# texts of the audit log
PROCESSED_TEXT = "Processed by load"
UNPUBLISH_STATUS_TEXT = "Unpublished - Status changed to 1, 2 or 4"
UNPUBLISH_PAST_TEXT = "Unpublished - demolished, past cases"
UNPUBLISH_DEMOLISHED_TEXT = "Unpublish - demolished"
