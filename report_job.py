"""Script for ``spark-submit``: run all reports (see README)."""

from vestibule.__main__ import main

if __name__ == "__main__":
    main()
