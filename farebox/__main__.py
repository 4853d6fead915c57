from farebox.plans.jobs import main

main()
