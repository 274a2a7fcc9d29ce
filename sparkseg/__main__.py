from sparkseg.plans.app import main

main()
