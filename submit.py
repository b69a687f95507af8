"""For spark-submit, which runs files rather than modules."""

from linefit.__main__ import main

if __name__ == "__main__":
    main()
