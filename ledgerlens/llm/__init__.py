"""Operators that prepare training text for language models; nothing else in the library needs them."""
