from gaugeline.plans.cli import main

main()
