"""Start a job under spark-submit; see `python -m tallyroom --help`."""

from tallyroom.__main__ import main

if __name__ == "__main__":
    main()
