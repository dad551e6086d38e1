"""Row rules, key assignment, upserts and size-checked joins."""
