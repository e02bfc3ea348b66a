import sys

from starloom.plans.job import main

sys.exit(main())
