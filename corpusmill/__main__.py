import sys

from corpusmill.cli import main

sys.exit(main())
