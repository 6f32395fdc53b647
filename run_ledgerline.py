"""spark-submit run_ledgerline.py <command> ...: the command line as a script."""

from ledgerline.__main__ import main

if __name__ == "__main__":
    main()
