"""The queries this repository is checked and measured with."""
