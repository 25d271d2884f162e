"""Tables read, reports written and read back."""
