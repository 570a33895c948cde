"""Entry script for ``spark-submit``; see ``tributary.cli``."""

from tributary.cli import main

if __name__ == "__main__":
    main()
