import sys

from millrace.plans.job import main

main(sys.argv[1:])
