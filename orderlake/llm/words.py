"""Words of whole texts, as bytes."""

# Lower-cases A-Z and leaves all other bytes as they are.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words(text: str | None) -> list[bytes]:
    """The runs of `[^\\x20\\x09-\\x0D]`, A-Z in lower case: `bytes.split` cuts at just these."""
    return text.encode().translate(LOWER).split() if text else []
