"""Names, widths and headers that outputs must carry exactly."""

# Hash length in hex characters -> hash type.
HASH_LENGTHS = {"md5": 32, "sha1": 40, "sha256": 64}

# A pseudonymous id starts with one of these.
PEL_PREFIXES = ("XY", "Xi")

# A person key is this long and starts with one of these.
CLINK_LENGTH = 16
CLINK_PREFIXES = ("0000GB", "0000FR")

# Person keys that share a hash are ranked by this many trailing characters.
CLINK_RANK_SUFFIX = 16

# Column preferred as the pseudonymous id of an account line.
PREFERRED_PEL_KEY = "LRI_DER_LRI_SHA256_EMAIL1"

KEY_VALUE_SEPARATOR = "="
ROW_KEY_SEPARATOR = "#"

PEL_FAMILY = "pel"
PEL_QUALIFIER = "pel"
HASH_FAMILY = "hashes"
EMAIL_FAMILY = "email"
PHONE_FAMILY = "phone"

MATCH_HEADER = "cookie|md5|sha1|sha256"
ENCRYPTED_HEADER = "PEL,EXTERN_ID,EMAIL,LN,FN,GEN,FI,CT,ZIP,PHONE,DOBY,DOBM,DOBD,COUNTRY"
