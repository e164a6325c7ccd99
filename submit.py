"""Script form of the command line for ``spark-submit`` (see cartwheel/__main__.py)."""

from cartwheel.__main__ import main

if __name__ == "__main__":
    main()
