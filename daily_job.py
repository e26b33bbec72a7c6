"""Command line of the daily job; see ``--help``."""

from tillwork.plans.job import main

if __name__ == "__main__":
    main()
