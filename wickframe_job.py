"""spark-submit entry file; ship the package with ``--py-files``."""

from wickframe.jobs import main

if __name__ == "__main__":
    main()
