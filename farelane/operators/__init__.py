"""Row-level, grouping and join operators.  All are ``DataFrame -> DataFrame``."""
