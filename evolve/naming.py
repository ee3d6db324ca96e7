"""Names for old data that is kept beside the new."""

LEGACY_PREFIX = "legacy__"


def legacy_name(name: str) -> str:
    """The name under which a replaced column or table is kept."""
    return name if name.startswith(LEGACY_PREFIX) else LEGACY_PREFIX + name
